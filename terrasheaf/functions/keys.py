"""Column functions for keys and typed values: columns in, column out, no actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How tiles are written, and the namespaces of field and boundary ids.
TILE = r"(?i)(h\d{2}v\d{2})"
FIELD_NAMESPACE = "9e6c1b5a-84d9-49c6-89df-cf8f1ca0af31"
BOUNDARY_NAMESPACE = "8a0f82f6-e540-4fc8-8f46-b6ce1c0df723"


def blank_to_null(c: Column) -> Column:
    """Trimmed text; blank is null."""
    return F.nullif(F.trim(c), F.lit(""))


def pick(*cols: Column) -> Column:
    """The first value that is not blank."""
    return F.coalesce(*map(blank_to_null, cols))


def tile_from_text(c: Column, variant: str = "any") -> Column:
    """The first hNNvNN in a text, lower-cased; ``variant``: any, word (at word boundaries), exact (the whole text) or prefix (a leading
    letter-digit name such as a path's first part)."""
    pattern = {"any": TILE, "word": rf"(?i)\b{TILE[4:]}\b", "exact": rf"(?i)^\s*{TILE[4:]}\s*$", "prefix": r"(?i)^([a-z]\d+[a-z]\d+)"}[variant]
    return F.nullif(F.lower(F.regexp_extract(c, pattern, 1)), F.lit(""))


def normalize_id(c: Column, variant: str = "text") -> Column:
    """An id without float artefacts. ``text``: a trailing .0 goes; ``number``: any integral number becomes integer text; ``tile``: the part
    after a tile prefix is treated as a number and the tile lower-cased; ``nan``: also NaN is blank; ``strict``: signed digits and .0 only."""
    text = blank_to_null(c)
    if variant == "text":
        return F.regexp_replace(text, r"\.0$", "")
    whole = F.regexp_replace(text, r"^([+-]?\d+)\.0+$", "$1")
    if variant == "strict":
        return whole
    number = text.try_cast("double")
    integral = F.when((number == F.floor(number)) & (F.abs(number) < 1e15), number.cast("long").cast("string")).otherwise(text)
    if variant == "number":
        return F.when(F.isnan(number), text).otherwise(integral)
    if variant == "nan":
        return F.when(F.lower(text).isin("nan", "none", "null"), None).otherwise(integral)
    parts = F.split(text, "_", 2)
    right = F.regexp_replace(F.element_at(parts, 2), r"^([+-]?\d+)\.0+$", "$1")
    return F.when(text.contains("_"), F.concat(F.lower(parts[0]), F.lit("_"), right)).otherwise(whole)


def tile_field_id(explicit: list[Column], tiles: list[Column], fields: list[Column]) -> Column:
    """The key <tile>_<field>: an explicit id that has an underscore, else one with the tile put before it, else tile and field; else null."""
    given, tile, field = pick(*explicit), tile_from_text(pick(*tiles)), normalize_id(pick(*fields), "strict")
    joined = lambda x: F.when(tile.isNotNull() & x.isNotNull(), F.concat(tile, F.lit("_"), x))
    return F.when(given.contains("_"), given).otherwise(F.coalesce(joined(given), joined(field)))


def split_tile_field_id(c: Column) -> tuple[Column, Column]:
    """Tile and field, split at the first underscore; both empty if there is none."""
    parts = F.split(c, "_", 2)
    return F.when(c.contains("_"), parts[0]).otherwise(""), F.when(c.contains("_"), F.element_at(parts, -1)).otherwise("")


def alias_map(df: DataFrame, aliases: dict[str, list[str]]) -> dict[str, str]:
    """For each target the first of its aliases that the table has, in any case; a target without one is an error."""
    have = {c.lower(): c for c in df.columns}
    chosen = {t: next((have[n.lower()] for n in names if n.lower() in have), None) for t, names in aliases.items()}
    missing = [t for t, c in chosen.items() if c is None]
    if missing:
        raise ValueError(f"no column for {', '.join(missing)}")
    return chosen


def alias_columns(df: DataFrame, aliases: dict[str, list[str]], report: bool = False) -> DataFrame:
    """One column for each target, by ``alias_map``; with ``report`` also the name of the column that it is from, as <target>_from."""
    chosen = alias_map(df, aliases)
    return df.select(*(F.col(c).alias(t) for t, c in chosen.items()), *(F.lit(c).alias(f"{t}_from") for t, c in chosen.items() if report))


def year_month(c: Column) -> tuple[Column, Column]:
    """Year text and month of six digits; nulls otherwise."""
    ok = F.trim(c).rlike(r"^\d{6}$")
    return F.when(ok, F.substring(F.trim(c), 1, 4)), F.when(ok, F.substring(F.trim(c), 5, 2).cast("int"))


def to_number(c: Column, strict: bool = False) -> Column:
    """A double; what does not parse is null, or an error if ``strict``. NaN is null."""
    number = F.nanvl(blank_to_null(c).try_cast("double"), F.lit(None).cast("double"))
    if not strict:
        return number
    return F.when(number.isNull(), F.raise_error(F.concat(F.lit("not a number: "), F.coalesce(c.cast("string"), F.lit("blank"))))).otherwise(number)


def number_or_text(c: Column) -> tuple[Column, Column]:
    """The number if the text is one, and the text if it is not."""
    number = to_number(c)
    return number, F.when(number.isNull(), blank_to_null(c))


def annual_tillage(c: Column) -> Column:
    """0 or 1; blank is null and anything else an error."""
    text = blank_to_null(c)
    return F.when(text.isNull() | text.isin("0", "1"), text.try_cast("int")).otherwise(F.raise_error(F.concat(F.lit("tillage must be 0 or 1: "), text)).cast("int"))


def dominant_tillage(p0: Column, p1: Column, n0: Column, n1: Column) -> Column:
    """The class with the larger proportion if both are there, a tie giving null; else that with the larger count; else null."""
    larger = lambda a, b: F.when(a > b, 0).when(b > a, 1)
    return F.when(p0.isNotNull() & p1.isNotNull(), larger(p0, p1)).when(n0.isNotNull() & n1.isNotNull(), larger(n0, n1))


def tillage_prop_01(p0: Column, p1: Column) -> Column:
    """The share of class 1 in classes 0 and 1, nulls counting as 0; null if there is nothing."""
    a, b = F.coalesce(p0, F.lit(0.0)), F.coalesce(p1, F.lit(0.0))
    return F.when(a + b > 0, b / (a + b))


def tillage_shares(p0: Column, p1: Column, nulls_as_zero: bool = True) -> dict[str, Column]:
    """The unclassified share and shares among what is classified."""
    a, b = (F.coalesce(p0, F.lit(0.0)), F.coalesce(p1, F.lit(0.0))) if nulls_as_zero else (p0, p1)
    classified = a + b
    return {
        "tillage_na_prop": F.greatest(F.lit(0.0), 1 - a - b),
        "classified_share": classified,
        "high_share_among_classified": F.try_divide(b, F.nullif(classified, F.lit(0.0))),
        "low_share_among_classified": F.try_divide(a, F.nullif(classified, F.lit(0.0))),
    }


def uuid5(namespace: str, name: Column) -> Column:
    """The version 5 UUID of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), name.cast("binary")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1).cast("int"), F.lit(1))
    return F.concat(F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12))


def field_uuid(source: Column, tile: Column, field: Column) -> Column:
    return uuid5(FIELD_NAMESPACE, F.concat_ws("|", source, tile, field))


def boundary_uuid(source: Column, resolution: Column, valid_start: Column, valid_end: Column, tile: Column, field: Column, geometry_hash: Column) -> Column:
    """The id of a field's boundary; an unknown start or end is blank."""
    blank = F.lit("")
    return uuid5(BOUNDARY_NAMESPACE, F.concat_ws("|", source, resolution, F.coalesce(valid_start, blank), F.coalesce(valid_end, blank), tile, field, geometry_hash))


def ring_text(ring: Column) -> Column:
    """One spelling of a ring, for hashing."""
    point = lambda p: F.concat(F.round(p["x"], 6).cast("string"), F.lit(" "), F.round(p["y"], 6).cast("string"))
    return F.array_join(F.transform(ring, point), ",")


def geometry_hash(ring: Column) -> Column:
    return F.sha2(ring_text(ring).cast("binary"), 256)


def state_code(c: Column, column_name: str = "") -> Column:
    """Upper-case letters and digits; the first two letters of a survey-area symbol."""
    code = F.regexp_replace(F.upper(c), r"[^A-Z0-9]", "")
    return F.nullif(F.substring(code, 1, 2) if "symbol" in column_name.lower() else code, F.lit(""))


def bounds(c: Column) -> Column:
    """Four comma-separated finite numbers with max over min, as a struct; null otherwise."""
    parts = F.transform(F.split(c, ","), lambda x: F.trim(x).try_cast("double"))
    x0, y0, x1, y1 = (F.try_element_at(parts, F.lit(k)) for k in range(1, 5))
    finite = F.size(parts) == 4
    for x in (x0, y0, x1, y1):
        finite = finite & x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.when(finite & (x1 > x0) & (y1 > y0), F.struct(x0.alias("minx"), y0.alias("miny"), x1.alias("maxx"), y1.alias("maxy")))
