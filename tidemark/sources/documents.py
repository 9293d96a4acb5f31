"""Nested JSON documents to typed tables, by VARIANT columns and rules of paths.

A family of rows is an array somewhere in a document. One scan splits documents
into the items of all families (``split``), which may be written, a folder for
each; a family's items then become typed rows, each with the rules that it
breaks. Nothing is inferred: a path's type is stated, and what isn't of it is a
reject, not a null.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import ohlc_consistent
from tidemark.functions.temporal import parse_temporal
from tidemark.operators.quality import scope_faults

#: Family of the row that stands for a text which is no JSON document.
NO_DOCUMENT = "not_a_document"
_NUMBER = r"^-?\d+(\.\d+)?$"


@dataclass(frozen=True)
class Field:
    """A path of an item: string (not blank), text, date, datetime, temporal (either), decimal (quoted), number (not quoted), integer, boolean or any.

    minimum bounds numbers; among lists the values of a string; precision names
    the field that must say what precision a temporal has.
    """

    name: str
    kind: str = "string"
    nullable: bool = False
    minimum: float | None = None
    among: tuple[str, ...] = ()
    precision: str | None = None
    path: str | None = None

    def at(self) -> str:
        return self.path or f"$.{self.name}"


@dataclass(frozen=True)
class Family:
    """An array of items at path, or at inner in each item of it; outer names fields of the outer item that its rows carry.

    single: there is one item, an object, in place of an array. exact: an item has no other keys.
    """

    name: str
    path: str
    fields: tuple[Field, ...]
    inner: str | None = None
    outer: tuple[str, ...] = ()
    single: bool = False
    exact: bool = False


def _items(value: Column, path: str, single: bool) -> Column:
    if single:
        one = F.try_variant_get(value, path, "variant")
        return F.when(one.isNotNull() & (F.schema_of_variant(one) != "VOID"), F.array(one))
    return F.try_variant_get(value, path, "array<variant>")


def _entries(doc: Column, family: Family) -> Column:
    """The family's items in a document: family, place, outer and item of each."""
    nothing = F.array().cast("array<struct<family:string,place:array<int>,outer:map<string,string>,item:variant>>")
    no_map = F.lit(None).cast("map<string,string>")
    entry = lambda place, outer, item: F.struct(F.lit(family.name).alias("family"), place.alias("place"), outer.alias("outer"), item.alias("item"))
    if family.inner is None:
        return F.coalesce(F.transform(_items(doc, family.path, family.single), lambda x, i: entry(F.array(i), no_map, x)), nothing)
    names = F.array(*[F.lit(o) for o in family.outer])
    carried = lambda x: F.map_from_arrays(names, F.array(*[F.try_variant_get(x, f"$.{o}", "string") for o in family.outer])) if family.outer else no_map
    inside = lambda x, i: F.coalesce(F.transform(_items(x, family.inner, family.single), lambda y, j: entry(F.array(i, j), carried(x), y)), nothing)
    return F.coalesce(F.flatten(F.transform(_items(doc, family.path, False), inside)), nothing)


def split(documents: DataFrame, families: Sequence[Family], text: str = "text", context: dict[str, str] | None = None) -> DataFrame:
    """The items of all families: the documents' other columns, family, place (positions from 0), carried and item.

    carried maps the outer item's fields, and the document's values at context's
    paths, to strings. A text that is no JSON gives one row of NO_DOCUMENT.
    """
    keep = [c for c in documents.columns if c != text]
    read = documents.select(*keep, F.try_parse_json(text).alias("_doc"))
    no_map = F.lit(None).cast("map<string,string>")
    whole = F.map_from_arrays(F.array(*[F.lit(k) for k in context]), F.array(*[F.try_variant_get("_doc", p, "string") for p in context.values()])) if context else no_map
    broken = F.array(F.struct(F.lit(NO_DOCUMENT).alias("family"), F.array(F.lit(0)).alias("place"), no_map.alias("outer"), F.lit(None).cast("variant").alias("item")))
    rows = F.when(F.col("_doc").isNull(), broken).otherwise(F.flatten(F.array(*[_entries(F.col("_doc"), f) for f in families])))
    exploded = read.select(*keep, whole.alias("_whole"), F.explode(rows).alias("_r"))
    return exploded.select(*keep, "_r.family", "_r.place", F.map_concat(F.coalesce("_whole", F.create_map().cast("map<string,string>")), F.coalesce("_r.outer", F.create_map().cast("map<string,string>"))).alias("carried"), "_r.item")


def _once(fields: dict[str, Column], make) -> Column:
    """An array of one: make of a struct of the fields, each of which is evaluated once however often make names it."""
    return F.transform(F.array(F.struct(*[c.alias(n) for n, c in fields.items()])), make)


def _fault(field: Field, read: Column, i: int) -> Column:
    """What is wrong with field i of an item that was read, or null."""
    value, kind = read[f"v{i}"], read[f"k{i}"]
    out = F.when(kind.isNull(), "absent").when(kind == "VOID", F.lit(None if field.nullable else "null"))
    if field.kind == "any":
        return out
    whole = kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    expected = {"integer": whole, "boolean": kind == "BOOLEAN", "number": whole | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")}.get(field.kind, kind == "STRING")
    out = out.when(~expected, "type")
    if field.kind == "string":
        out = out.when(F.trim(value) == "", "blank")
    elif field.kind in ("date", "datetime", "temporal"):
        precision = read[f"p{i}"]
        out = out.when(precision.isNull() if field.kind == "temporal" else ~precision.eqNullSafe(field.kind), "format")
        if field.precision:
            out = out.when(~read[f"o{i}"].eqNullSafe(precision), "precision")
    elif field.kind == "decimal":
        out = out.when(~value.rlike(_NUMBER) | value.try_cast("decimal(28,10)").isNull(), "format")
    if field.minimum is not None:
        out = out.when(value.try_cast("decimal(28,10)") < F.lit(field.minimum), "minimum")
    if field.among:
        out = out.when(~value.isin(*field.among), "enum")
    return out


def _raw(family: Family, item: Column) -> dict[str, Column]:
    """What is at the paths of an item's fields, as variants; the precision that a time's item says; an exact item's keys."""
    raw = {f"r{i}": F.try_variant_get(item, f.at(), "variant") for i, f in enumerate(family.fields)}
    raw |= {f"o{i}": F.try_variant_get(item, f"$.{f.precision}", "string") for i, f in enumerate(family.fields) if f.precision}
    if family.exact:
        raw["keys"] = F.map_keys(F.try_variant_get(item, "$", "map<string,variant>"))
    return raw


def _texts(family: Family, x) -> dict[str, Column]:
    """Of field i its value as a text (v) and its kind (k; null: absent), from the raw fields x."""
    out = {n: x[n] for n in _raw(family, F.lit(None)) if n[0] != "r"}
    for i in range(len(family.fields)):
        out |= {f"v{i}": F.try_variant_get(x[f"r{i}"], "$", "string"), f"k{i}": F.schema_of_variant(x[f"r{i}"])}
    return out


def _times(family: Family, x) -> dict[str, Column]:
    """The precision (p) of the fields that are times, from their texts x."""
    return {f"p{i}": parse_temporal(x[f"v{i}"]).precision for i, f in enumerate(family.fields) if f.kind in ("date", "datetime", "temporal")}


def _read(family: Family, item: Column, make) -> Column:
    """An array of one: make of an item that was read, a path at a time."""
    names = list(_texts(family, {n: F.lit(None) for n in _raw(family, item)}))
    whole = lambda x: _once({n: x[n] for n in names} | _times(family, x), make)
    return F.flatten(F.flatten(_once(_raw(family, item), lambda x: _once(_texts(family, x), whole))))


_TYPES = {"date": "date", "decimal": "decimal(28,10)", "number": "double", "integer": "long", "boolean": "boolean"}


def _faults(family: Family, read: Column) -> Column:
    """All that is wrong with an item that was read, as field:rule."""
    faults = [F.concat(F.lit(f.name + ":"), _fault(f, read, i)) for i, f in enumerate(family.fields)]
    if family.exact:
        known = F.array(*[F.lit(f.at().split(".")[1]) for f in family.fields])
        faults.append(_unknown(F.array_except(read["keys"], known)))
    return F.array_compact(F.array(*faults))


def _unknown(others: Column) -> Column:
    return F.when(F.size(others) > 0, F.concat(F.array_join(F.array_sort(others), ","), F.lit(":unknown")))


def typed(items: DataFrame, family: Family) -> DataFrame:
    """The rows of one family: the documents' columns, carried ones, place, its fields in their types, and rejected (field:rule).

    A field that breaks a rule is null where its text isn't of the type.
    """
    keep = [c for c in items.columns if c not in ("family", "place", "carried", "item")]
    own = items.filter(F.col("family") == family.name).select(F.struct(*[F.col(c) for c in keep], "place", "carried").alias("_of"), "item")
    # a step is a projection, so that Spark compiles it; what a later one names twice stays in its own
    raw = _raw(family, F.col("item"))
    read = own.select("_of", *[c.alias(n) for n, c in raw.items()])
    texts = _texts(family, {n: F.col(n) for n in raw})
    read = read.select("_of", *[c.alias(n) for n, c in texts.items()])
    times = _times(family, {n: F.col(n) for n in texts})
    read = read.select("_of", *texts, *[c.alias(n) for n, c in times.items()])
    x = {n: F.col(n) for n in (*texts, *times)}
    values = [x[f"v{i}"].try_cast(_TYPES.get(f.kind, "string")).alias(f.name) for i, f in enumerate(family.fields)]
    # a generator, so that a filter of the rejected rows doesn't read each path again
    out = read.select("_of", F.explode(F.array(F.struct(*values, _faults(family, x).alias("rejected")))).alias("_t"))
    carried = [F.col("_of.carried")[o].alias(o) for o in family.outer]
    return out.select(*[F.col("_of")[c].alias(c) for c in keep], "_of.place", "_of.carried", *carried, *[F.col("_t")[f.name].alias(f.name) for f in family.fields], F.col("_t.rejected").alias("rejected"))


def rows_of(items: DataFrame, family: Family) -> DataFrame:
    """The typed rows of a family that break no rule."""
    return typed(items, family).filter(F.size("rejected") == 0).drop("rejected", "carried")


def rejects_of(items: DataFrame, families: Sequence[Family], keep: Sequence[str]) -> DataFrame:
    """keep, family, place and rule of everything that is rejected, of all families."""
    out = items.filter(F.col("family") == NO_DOCUMENT).select(*keep, "family", "place", F.lit("document:json").alias("rule"))
    for family in families:
        out = out.unionByName(typed(items, family).filter(F.size("rejected") > 0).select(*keep, F.lit(family.name).alias("family"), "place", F.explode("rejected").alias("rule")))
    return out


_DAYS = r"[12]\d{3}-(?:(?:0[1-9]|1[0-2])-(?:0[1-9]|1\d|2[0-8])|(?:0[13-9]|1[0-2])-(?:29|30)|(?:0[13578]|1[02])-31)"
_MOMENTS = _DAYS + r"T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d{1,6})?(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)"
_SAID = {"date": _DAYS, "datetime": _MOMENTS}
_NOT_A_NUMBER = '(?!-?Infinity"|NaN")'  # a number beyond doubles is copied as such a text
#: A value of each kind that breaks no rule of it, as JSON; not all such values.
_FORMS = {
    "string": f'"{_NOT_A_NUMBER}' + r' *+[^"\\ ][^"\\]*+"', "text": f'"{_NOT_A_NUMBER}' + r'[^"\\]*+"', "date": f'"{_DAYS}"', "datetime": f'"{_MOMENTS}"', "temporal": f'"(?:{_DAYS}|{_MOMENTS})"',
    "decimal": r'"-?\d{1,18}(?:\.\d{1,10})?"', "integer": r"-?(?:0|[1-9]\d{0,17})", "boolean": "(?:true|false)", "any": r'(?:"[^"\\]*+"|true|false|-?\d{1,18})',
}
#: An item with more parts in an inner array is read field by field.
_INNER_PARTS = 32


def _at_least(least: int) -> str:
    """Whole numbers from least on, of up to 18 digits."""
    digits = str(least)
    above = [f"{digits[:i]}[{int(d) + 1}-9]\\d{{{len(digits) - i - 1}}}" for i, d in enumerate(digits) if d != "9"]
    return f"(?:{'|'.join([digits, *above, f'[1-9]\\d{{{len(digits)},17}}'])})"


def _form(field: Field, said: str | None, own: str | None = None) -> str | None:
    """JSON of which it is certain that a field takes it, as a pattern; said: the precision that the item says of it; own: the one text to take."""
    form = _FORMS.get(field.kind)
    if own:
        return f'"{own}"' if field.kind in ("string", "text") and field.minimum is None and own in (field.among or (own,)) else None
    if field.among:
        plain = [a for a in field.among if re.fullmatch(r"\w+", a) and a not in ("Infinity", "NaN")] if field.kind == "string" else []
        form = f'"(?:{"|".join(plain)})"' if plain else None
    elif field.precision:
        form = f'"{_SAID[said]}"' if field.kind == "temporal" else None
    if field.minimum is not None:
        whole = field.minimum >= 0 and field.minimum == int(field.minimum)
        if field.kind == "integer" and whole:
            form = _at_least(int(field.minimum))
        else:
            form = form.replace("-?", "", 1) if form and field.kind == "decimal" and field.minimum == 0 else None
    return form and (f"(?:{form}|null)" if field.nullable else form)


def _certain(family: Family, inner: Sequence[Family]) -> str | None:
    """A pattern of items that certainly break no rule, nor do their inner items: all keys in the order of the fields, and no other; null if there is none."""
    timed = [f for f in family.fields if f.precision]
    said = {f.precision: f"$.{f.precision}" for f in timed}
    if (family.exact and inner) or len(timed) > 2 or len(said) < len(timed) or not set(said.values()) <= {f.at() for f in family.fields}:
        return None
    ways, parts = [], []
    for g in inner:
        part = _certain(g, [])
        parts.append((g.inner, part if g.single or part is None else rf"\[(?:{part}(?:,{part}){{0,{_INNER_PARTS - 1}}})?\]"))
    for kinds in itertools.product(_SAID, repeat=len(timed)):
        of = dict(zip(said, kinds))
        own = {said[n]: kind for n, kind in of.items()}
        pairs = [(f.at(), _form(f, of.get(f.precision), own.get(f.at()))) for f in family.fields] + parts
        if all(form and re.fullmatch(r"\$(\.\w+)+", path) for path, form in pairs):
            ways.append(_object([(path.split(".")[1:], form) for path, form in pairs]))
    return f"(?:{'|'.join(ways)})" if ways and None not in ways else None


def _object(pairs: Sequence[tuple[list[str], str]]) -> str | None:
    """A pattern of an object from (path, pattern of the value) pairs; null if a path is also the beginning of another."""
    heads, parts = dict.fromkeys(p[0] for p, _ in pairs), []
    for head in heads:
        below = [(p[1:], form) for p, form in pairs if p[0] == head]
        ends = [form for p, form in below if not p]
        form = ends[0] if len(below) == len(ends) == 1 else None if ends else _object(below)
        if form is None:
            return None
        parts.append(f'"{head}":{form}')
    return rf"\{{{','.join(parts)}\}}"


_CORRUPT = "_corrupt"


def _parts_type(families: Sequence[Family]) -> str | None:
    """The type of a document whose items are texts: strings at the families' outer paths; null if they don't make one."""

    def struct(pairs):
        heads = dict.fromkeys(p[0] for p, _ in pairs)
        if len({h.lower() for h in heads}) < len(heads):
            return None
        parts = []
        for head in heads:
            below = [(p[1:], kind) for p, kind in pairs if p[0] == head]
            ends = [kind for p, kind in below if not p]
            kind = ends[0] if len(below) == len(ends) == 1 else None if ends else struct(below)
            if kind is None:
                return None
            parts.append(f"`{head}`:{kind}")
        return f"struct<{','.join(parts)}>"

    outer = [f for f in families if not f.inner]
    paths = [f.path for f in outer]
    if len(set(paths)) < len(paths) or not {f.path for f in families if f.inner} <= {f.path for f in outer if not f.single} or not all(re.fullmatch(r"\$(\.\w+)+", p) for p in paths):
        return None
    whole = struct([(f.path.split(".")[1:], "string" if f.single else "array<string>") for f in outer])
    return whole and f"{whole[:-1]},`{_CORRUPT}`:string>"


def document_rejects(documents: DataFrame, families: Sequence[Family], keep: Sequence[str], text: str = "text") -> DataFrame:
    """As ``rejects_of``, of the documents themselves: one scan, whose rows are the rejected items only.

    An item whose text matches a pattern of what the rules take is right; only
    others are read field by field. So it is in documents without a backslash,
    where no string holds a quote and so none looks like an item; the
    items of other documents are all read.
    """
    groups: dict[tuple[str, bool], list[Family]] = {}  # by outer item
    for f in families:
        groups.setdefault((f.path, f.single and not f.inner), []).append(f)
    parts = None if any(f.kind == "number" for family in families for f in family.fields) else _parts_type(families)  # a text of an item gives numbers as doubles
    read = documents.select(*keep, F.try_parse_json(text).alias("_doc"), *([_parts(F.col(text), parts).alias("_parts")] if parts else []))
    whole = [_rows(_items(F.col("_doc"), path, single), n, "item") for n, (path, single) in enumerate(groups)]
    doubtful = [_rows(_part(path, single), n, "text", _certain(next(f for f in own if not f.inner), [f for f in own if f.inner])) for n, ((path, single), own) in enumerate(groups.items())] if parts else []
    rows = F.flatten(F.array(*whole))
    if parts:
        rows = F.when(F.col("_parts").isNull() | F.col(f"_parts.{_CORRUPT}").isNotNull(), rows).otherwise(F.flatten(F.array(*doubtful)))
    rows = F.when(F.col("_doc").isNull(), _rows(F.array(F.lit(None).cast("string")), -1, "text")).otherwise(rows)
    items = read.select(*keep, F.explode(rows).alias("_r"))
    items = items.select(*keep, F.col("_r.of").alias("_of"), F.col("_r.i").alias("_i"), F.when(F.col("_r.text").isNotNull(), _parsed(F.col("_r.text"))).otherwise(F.col("_r.item")).alias("_item"))
    found = F.when(F.col("_of") == -1, F.array(F.struct(F.lit(NO_DOCUMENT).alias("family"), F.array("_i").alias("place"), F.array(F.lit("document:json")).alias("rules"))))
    for n, own in enumerate(groups.values()):
        found = found.when(F.col("_of") == n, F.flatten(F.array(*[_broken_rules(f, F.col("_item"), F.col("_i")) for f in own])))
    return items.select(*keep, F.explode(found).alias("_r")).select(*keep, "_r.family", "_r.place", F.explode("_r.rules").alias("rule"))


def _parts(text: Column, kind: str) -> Column:
    """The texts of a document's items, by one reading; null where a string may hold a quote or look like a number beyond doubles, or the document is no object."""
    return F.when(text.rlike(r"^\s*\{") & ~text.contains("\\") & ~text.contains('Infinity"'), F.from_json(text, kind, {"columnNameOfCorruptRecord": _CORRUPT}))


def _parsed(text: Column) -> Column:
    """The item of a text of ``_parts``, in which a number beyond doubles stands as a string."""
    return F.try_parse_json(F.replace(F.replace(text, F.lit('"Infinity"'), F.lit("1e999")), F.lit('"-Infinity"'), F.lit("-1e999")))


def _part(path: str, single: bool) -> Column:
    value = F.col("_parts")
    for name in path.split(".")[1:]:
        value = value[name]
    return F.when(value.isNotNull(), F.array(value)) if single else value


def _rows(items: Column, of: int, name: str, certain: str | None = None) -> Column:
    """The items of a document, as variants or texts, with their number of a path and their place; without texts that match a pattern."""
    kind = "array<struct<of:int,i:int,item:variant,text:string>>"
    column = lambda x, n: x if n == name else F.lit(None).cast("variant" if n == "item" else "string")
    rows = F.transform(items, lambda x, i: F.struct(F.lit(of).alias("of"), i.alias("i"), column(x, "item").alias("item"), column(x, "text").alias("text")))
    if certain:
        rows = F.filter(rows, lambda r: ~F.coalesce(r["text"].rlike(f"^{certain}$"), F.lit(False)))
    return F.coalesce(rows, F.array().cast(kind))


def _broken_rules(family: Family, item: Column, i: Column) -> Column:
    """Family, place and broken rules of an item, or of the family's items inside it, without those that break none."""
    rules = lambda x: F.get(_read(family, x, lambda read: _faults(family, read)), F.lit(0))
    entry = lambda place, x: F.struct(F.lit(family.name).alias("family"), place.alias("place"), rules(x).alias("rules"))
    if family.inner is None:
        found = F.array(entry(F.array(i), item))
    else:
        found = F.transform(_items(item, family.inner, family.single), lambda x, j: entry(F.array(i, j), x))
    return F.filter(F.coalesce(found, F.array().cast("array<struct<family:string,place:array<int>,rules:array<string>>>")), lambda r: F.size(r["rules"]) > 0)


def _f(text: str, kind: str = "string", **more) -> list[Field]:
    return [Field(n, kind, **more) for n in text.split()]


_AVAILABLE = (Field("available_at", "temporal", precision="available_precision"), Field("available_precision", among=("date", "datetime")))

# Fixed names of the fields of input documents.
COMPANY = (
    Family("issuers", "$.issuers", (*_f("issuer_key cik legal_name entity_type"), Field("state", among=("active", "tombstone")), *_AVAILABLE)),
    Family("issuer_links", "$.issuers", (*_f("link_kind provider provider_identifier"), Field("valid_from", "date"), Field("valid_through", "date", nullable=True), Field("confidence"), *_AVAILABLE), inner="$.links", outer=("issuer_key",)),
    Family("filings", "$.filings", (*_f("accession_number form"), Field("filing_date", "date"), Field("accepted_at", "temporal", precision="accepted_precision"), Field("accepted_precision"), Field("report_period", "date", nullable=True), *_f("primary_document source_url first_observed_issuer_key"))),
    Family("mappings", "$.mappings", tuple(_f("mapping_version taxonomy concept unit metric_code metric_kind metric_label"))),
    Family("facts", "$.facts", (*_f("source_fact_key issuer_key taxonomy concept unit"), Field("period_kind", among=("instant", "duration")), Field("period_start", "date", nullable=True), Field("period_end", "date"), Field("fiscal_year", "integer", minimum=1900), *_f("fiscal_period accession_number mapping_version"), Field("dimensions", "any"), Field("value", "decimal"))),
    Family("actions", "$.actions", (*_f("action_key"), Field("action_type", among=("dividend", "split")), *_f("issuer_key provider provider_symbol"), Field("event_date", "date"), Field("terms", "any"), *_AVAILABLE)),
    Family("earnings_events", "$.earnings_events", (*_f("event_key event_type status issuer_key provider"), *_f("event_date fiscal_period_end", "date"), *_AVAILABLE)),
    Family("expectations", "$.expectations", (*_f("expectation_key issuer_key provider"), Field("event_key", nullable=True), Field("event_date", "date"), Field("metric_code"), Field("fiscal_period_end", "date"), Field("currency"), Field("value", "decimal"), *_AVAILABLE)),
    Family("guidance", "$.guidance", (*_f("guidance_key issuer_key provider"), Field("accession_number", nullable=True), Field("metric_code"), Field("target_period_end", "date"), Field("value_shape", among=("point", "range")), *_f("value_point value_low value_high", "decimal", nullable=True), *_f("currency review_state source_url"), *_AVAILABLE)),
)

_CONTEXT = (*_AVAILABLE, *_f("feed environment"))
_QUOTE = tuple(Field(n, k, nullable=True, path=f"$.quote.{n}") for n, k in (*((p, "decimal") for p in "bid_price ask_price last_price implied_volatility delta gamma theta vega rho".split()), *((p, "integer") for p in "bid_size ask_size last_size volume".split())))
_STATE = (Field("state", among=("present", "missing")), Field("missing_reason", nullable=True))
OPTIONS = (
    Family("capture", "$.capture", (*_f("underlying_key requested_feed resolved_feed environment"), Field("completeness"), Field("deliverable_policy", among=("standard_only", "all")), *_AVAILABLE), single=True),
    Family("contracts", "$.contracts", (*_f("provider provider_contract_id contract_symbol"), Field("expiration_date", "date"), Field("strike_price", "decimal", minimum=0), Field("option_type", among=("call", "put")), Field("deliverable_kind", among=("standard", "nonstandard")), Field("contract_multiplier", "integer", minimum=1), Field("contract_status"), *_CONTEXT)),
    Family("surface", "$.surface", (Field("provider_contract_id"), Field("surface_state", among=("present", "missing", "excluded")), *_f("missing_reason exclusion_reason", nullable=True), *_QUOTE, *_CONTEXT)),
    Family("open_interest", "$.surface", (Field("as_of_date", "date", nullable=True), *_STATE, Field("value", "integer", nullable=True, minimum=0)), inner="$.open_interest", outer=("provider_contract_id",), single=True),
    Family("close_prices", "$.surface", (Field("trade_date", "date", nullable=True), *_STATE, Field("value", "decimal", nullable=True, minimum=0)), inner="$.close_price", outer=("provider_contract_id",), single=True),
    Family("bars", "$.surface", (Field("timeframe"), *_f("bar_start bar_end", "temporal"), *_STATE, *_f("open high low close", "decimal", nullable=True), Field("volume", "integer", nullable=True, minimum=0)), inner="$.bars", outer=("provider_contract_id",)),
    Family("underlying_quote", "$.inputs.underlying_quote", (*_STATE, *_f("bid_price ask_price last_price trade_price", "decimal", nullable=True), *_CONTEXT), single=True),
    Family("rate_points", "$.inputs.rate_curve.points", (Field("tenor_days", "integer", minimum=1), *_STATE, Field("zero_rate", "decimal", nullable=True))),
    Family("dividends", "$.inputs.dividend_set.cashflows", (Field("ex_date", "date"), Field("pay_date", "date", nullable=True), *_STATE, Field("cash_amount", "decimal", nullable=True, minimum=0))),
    Family("expiry_inputs", "$.inputs.expiry_inputs", (Field("expiration_date", "date"), *_STATE, *_f("spot_price risk_free_rate dividend_yield forward_price", "decimal", nullable=True), *_CONTEXT)),
)

_LABEL = {"inner_of": "$.items", "outer": ("source_item_id",)}
_LABEL_STATE = (Field("state", among=("present", "missing", "not_applicable")), Field("missing_reason", nullable=True))
NEWS = (
    Family("items", "$.items", (*_f("source_item_id source_kind"), Field("published_at", "temporal", nullable=True), Field("content_state", path="$.content.state", among=("present", "missing")), *[Field(n, "text", nullable=True, path=f"$.content.{n}") for n in "headline body summary source_url missing_reason".split()], Field("item_state", among=("active", "retracted")), Field("retraction_reason", nullable=True))),
    *[
        Family(name, _LABEL["inner_of"], (*_LABEL_STATE, *own), inner=f"$.labels.{name}", outer=_LABEL["outer"])
        for name, own in {
            "symbols": tuple(_f("instrument_id provider provider_symbol", nullable=True)), "topics": (Field("topic", nullable=True), Field("confidence", "decimal", nullable=True, minimum=0)),
            "geographies": (Field("geography_code", nullable=True),), "coverage_lanes": (Field("coverage_lane", nullable=True),),
        }.items()
    ],
)

_EFFECTIVE = (Field("effective_from", "date"), Field("effective_through", "date", nullable=True))
CATALOG = (
    Family("instruments", "$.instruments", (*_f("instrument_key asset_type canonical_symbol display_name"), Field("active", "boolean"))),
    Family("identifiers", "$.instruments", (*_f("provider provider_symbol"), Field("valid_from", "date"), Field("valid_through", "date", nullable=True), *_AVAILABLE), inner="$.identifiers", outer=("instrument_key",)),
    Family("classifications", "$.classifications", (*_f("instrument_key classification_provider"), *_f("sector industry", nullable=True), *_EFFECTIVE, *_AVAILABLE)),
    Family("universe", "$.universe", (*_f("universe_key display_name"), Field("completeness", among=("complete", "partial")), *_AVAILABLE), single=True),
    Family("members", "$.universe.members", (Field("instrument_key"), *_EFFECTIVE)),
)

BARS = Family("bars", "$", (Field("symbol"), Field("date", "date"), *_f("open high low close", "number", minimum=0), Field("volume", "integer", minimum=0), *_f("change changePercent vwap", "number")), exact=True)


def bar_array_faults(documents: DataFrame, scope: DataFrame, keep: Sequence[str]) -> DataFrame:
    """keep and rule of arrays of bars, each a document of one symbol: fields, other keys, prices that don't fit, several symbols, and days that weren't asked for.

    scope has keep, symbol, first_day, last_day, days and expected_rows, as in ``scope_faults``.
    """
    items = split(documents, [BARS])
    rows = typed(items, BARS)
    fields = rejects_of(items, [BARS], keep).select(*keep, "rule")
    whole = rows.filter(F.size("rejected") == 0)
    prices = whole.filter(~(ohlc_consistent(F.col("open"), F.col("high"), F.col("low"), F.col("close")) & (F.least("open", "high", "low", "close") > 0))).select(*keep, F.lit("prices").alias("rule"))
    asked = whole.join(scope.select(*keep, F.col("symbol").alias("_symbol")), list(keep), "left")
    others = asked.filter(F.col("symbol") != F.col("_symbol")).select(*keep, F.lit("other_symbol").alias("rule"))
    days = scope_faults(whole, scope, keep, ["date"], "date")
    return fields.unionByName(prices).unionByName(others).unionByName(days).distinct()


def family(families: Sequence[Family], name: str) -> Family:
    return next(f for f in families if f.name == name)
