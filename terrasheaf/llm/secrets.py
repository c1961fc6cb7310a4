"""Secrets in whole texts, told apart by who in the corpus owns them. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from terrasheaf.llm.common import join_counted, materialize

# The base rules, in their order. (?i) without (?u) folds A-Z alone.
BASE = {
    "assign": r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
#: The same with the least length built in, where no shorter match could hide a longer one: a run is matched whole or not at all.
HEX_SEARCH = r"[0-9a-f]{24,}+"
ACCESS_SEARCH = r"AKIA[A-Z0-9]{16,}+"
#: Candidates of further kinds, of any length. They become spans only if ownership in the corpus says that they are live. Each begins where
#: a run of its characters begins and takes the run whole (possessively), so the search stays linear.
FURTHER = {
    "provider": r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|rk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36})",
    "jwt": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "url": r"(?<=://)[A-Za-z0-9._%+-]++:[^\s:/@]{6,}+(?=@)",
    "opaque": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9])(?=[A-Z0-9+/_-]*+[a-z])(?=[a-z0-9+/_-]*+[A-Z])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])",
}
#: A candidate is an example that people copy if it has more independent owners or repositories, stands in more distinct texts, or its copies
#: reach more owners than this.
MAX_OWNERS, MAX_REPOS, MAX_TEXTS, MAX_COPY_OWNERS = 3, 5, 20, 5

# A private-use character marks where matches begin and end; one in the text itself is exchanged for its neighbour, of the same length.
MARK, STAND_IN = "\ue000", "\ue001"


def pieces(text: Column, pattern: str) -> Column:
    """The text cut at the ends of all matches: what does not match and what does, in turns."""
    marked = F.regexp_replace(F.translate(text, MARK, STAND_IN), F.lit(pattern), F.lit(f"{MARK}$0{MARK}"))
    return F.split(marked, MARK, -1)


def found(text: Column, kind: str, pattern: str) -> Column:
    """(kind, piece number, length, match or null) of each piece, or null for a text without a match."""
    parts = F.transform(pieces(text, pattern), lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("n"), F.char_length(x).alias("len"), F.when(i % 2 == 1, x).alias("hit")))
    return F.when(text.rlike(pattern), parts)


def scanned(rows: DataFrame) -> DataFrame:
    """Adds ``parts``: the pieces of each text, by kind, base kinds and others; empty where nothing matches. Texts are read once, here."""
    empty = F.array().cast("array<struct<kind:string,n:int,len:int,hit:string>>")
    searches = {"assign": BASE["assign"], "access": ACCESS_SEARCH, "hex": HEX_SEARCH} | FURTHER
    parts = F.concat(*(F.coalesce(found(F.col("text"), kind, pattern), empty) for kind, pattern in searches.items()))
    return rows.withColumn("parts", parts)


def candidates(rows: DataFrame) -> DataFrame:
    """(scan, text_key, repo, owner, kind, start, end, digest) of every match in ``rows`` (those columns and parts; scan tells rows apart).

    Starts are running sums of lengths per row and kind."""
    cut = rows.select("scan", "text_key", "repo", "owner", F.explode("parts").alias("p")).select("scan", "text_key", "repo", "owner", "p.*")
    before = Window.partitionBy("scan", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cut.withColumn("end", F.sum(F.col("len").cast("long")).over(before)).where(F.col("hit").isNotNull())
    value = F.regexp_extract("hit", BASE["assign"], 2)
    secret = F.when(F.col("kind") == "assign", value).otherwise(F.col("hit"))
    kept = placed.where((F.col("kind") != "assign") | (F.length(value) >= 6))
    return kept.select("scan", "text_key", "repo", "owner", "kind", (F.col("end") - F.col("len")).alias("start"), "end", F.sha2(secret, 256).alias("digest"))


def ownership(spans: DataFrame) -> DataFrame:
    """(digest, n_repos, n_owners, n_texts, n_copy_owners, n_spans): by how many repositories and owners each candidate is held, and in how
    many texts and places.

    Copies of a text count once in the first three: each distinct text is its first repository's and owner's. n_copy_owners counts the owners
    of all copies. All are counted in steps, so that a credential copied everywhere is few rows before it meets itself."""
    texts = spans.groupBy("digest", "text_key").agg(F.min("repo").alias("repo"), F.min("owner").alias("owner"), F.count(F.lit(1)).alias("n"))
    independent = texts.groupBy("digest").agg(F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"), F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_spans"))
    copies = spans.select("digest", "owner").distinct().groupBy("digest").agg(F.count("owner").alias("n_copy_owners"))
    return independent.join(copies, "digest")


def looks_live() -> Column:
    return (F.col("n_owners") <= MAX_OWNERS) & (F.col("n_repos") <= MAX_REPOS) & (F.col("n_texts") <= MAX_TEXTS) & (F.col("n_copy_owners") <= MAX_COPY_OWNERS)


def joined(spans: Column, *more: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], *(s[n].cast("string") for n in ("start", "end", *more)))), ",")


def find_secrets(docs: DataFrame, repo: Column | None = None, owner: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, live_spans and holders.

    ``repo`` and ``owner`` say where a document comes from (by default its source, and the source's name up to the first slash). Base matches
    are spans always. Further candidates (provider tokens, JWTs, credentials in addresses, opaque strings) are added unless the same secret is
    widely copied, by its repositories, owners and distinct texts together. n_live and n_example count distinct spans of either sort,
    live_spans lists those that look live, and holders every candidate, dropped ones too, as kind:start:end:repositories:owners:texts.

    Rows that repeat are judged and returned one by one, with the same result each; null or empty text has no spans; a null id, repository
    or owner is a value like any other (a null repository or owner counts as none); no rows give no rows; other columns are ignored. Matches
    may be of any length. A secret that stands in a large share of all places is joined to its owners without a shuffle (``join_counted``).
    """
    source = F.col("source") if "source" in docs.columns else F.lit(None).cast("string")
    repo = source if repo is None else repo
    owner = F.substring_index(source, "/", 1) if owner is None else owner
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text_key = F.concat_ws(":", F.hex(F.xxhash64(text)), F.char_length(text).cast("string"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), text_key.alias("text_key"), repo.cast("string").alias("repo"), owner.cast("string").alias("owner"))
    rows = materialize(scanned(rows).drop("text").withColumn("scan", F.monotonically_increasing_id()), "secret-scan")
    some = F.size("parts") > 0
    spans = materialize(candidates(rows.where(some)), "secret-candidates")
    owned = materialize(ownership(spans), "secret-owners")
    order = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).when(F.col("kind") == "hex", 2).otherwise(3)
    held = join_counted(spans.select("scan", "kind", "start", "end", "digest"), owned, "digest", "n_spans")
    judged = held.select("scan", "start", order.alias("rank"), "kind", "end", looks_live().alias("live"), "n_repos", "n_owners", "n_texts")
    grouped = judged.groupBy("scan").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end", "live", "n_repos", "n_owners", "n_texts"))).alias("found"))
    grouped = grouped.withColumn("all", F.filter("found", lambda s: (s["rank"] < 3) | s["live"]))
    grouped = grouped.withColumn("base", F.filter("all", lambda s: s["rank"] < 3))
    none = F.array().cast(T.ArrayType(grouped.schema["all"].dataType.elementType))
    full = rows.where(some).select("doc_id", "scan").join(grouped, "scan", "left").unionByName(rows.where(~some).select("doc_id", "scan"), allowMissingColumns=True)
    full = full.withColumn("found", F.coalesce("found", none)).withColumn("all", F.coalesce("all", none)).withColumn("base", F.coalesce("base", none))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return full.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("all")).alias("spans"),
        F.size(F.filter("all", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("all", lambda s: ~s["live"])).cast("long").alias("n_example"),
        joined(F.filter("all", lambda s: s["live"])).alias("live_spans"),
        joined(F.col("found"), "n_repos", "n_owners", "n_texts").alias("holders"),
    )
