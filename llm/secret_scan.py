"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by regular expressions: the three base kinds and ``generic``,
long mixed strings that no base pattern covers. The hash of every candidate value
is aggregated over the whole corpus by distinct repositories and distinct owners.
A value that many owners or very many repositories carry is a copied example; a value
that stays with few of both looks live. Base spans are always reported, with their class; a generic
span is reported only where its value looks live.

Positions without a UDF: ``split`` gives the text between the matches and
``regexp_extract_all`` the matches, so a running sum of lengths (code points)
within the document gives every start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinship.session import write_table

# The base patterns and their order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
GENERIC = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "generic")

MIN_ASSIGN = 6
#: a value carried by this many owners or more is a copied example
WIDE_OWNERS = 3
#: and so is one that stands in this many repositories or more, whoever owns them
WIDE_REPOS = 20

_HIT = "struct<kind:int,idx:int,pre:int,len:int,value:string>"


def _matches(docs: DataFrame, kind: int, regex: str, group: int) -> DataFrame:
    """Adds ``hits<kind>``: every match in order, with the length of the text before it."""
    text = F.col("_text")
    pre, whole, value, out = (f"_{x}{kind}" for x in ("pre", "whole", "value", "hits"))
    arrays = {pre: F.split(text, regex, -1), whole: F.regexp_extract_all(text, F.lit(regex), F.lit(0))}
    if group:
        arrays[value] = F.regexp_extract_all(text, F.lit(regex), F.lit(group))
    docs = docs.select("*", *[F.when(text.rlike(regex), a).alias(n) for n, a in arrays.items()])
    zipped = F.filter(F.arrays_zip(*arrays), lambda x: x[whole].isNotNull())
    hit = lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("idx"), F.length(x[pre]).alias("pre"),
        F.length(x[whole]).alias("len"), x[value if group else whole].alias("value"))
    return docs.select(*[c for c in docs.columns if c not in arrays], F.transform(zipped, hit).alias(out))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                repo_col: str | None = None, wide_owners: int = WIDE_OWNERS, wide_repos: int = WIDE_REPOS) -> DataFrame:
    """Find secrets in every whole text and tell copied examples from live-looking values.

    Returns one row per input row: ``(<id_col>, spans)``, ``spans`` an array of
    ``(start, kind, end, value_hash, n_owners, n_repos, looks_live)`` by start,
    then kind; ``kind`` indexes ``KINDS``; positions are code points, end
    exclusive; an ``assign`` span is the whole match, its value the second group.
    ``repo_col`` names the repository (default: each id is one); a null owner or
    repository counts as one unknown owner or repository. A value looks live when fewer
    than ``wide_owners`` owners and fewer than ``wide_repos`` repositories carry it.

    Null and empty texts have no spans. Repeated rows are scanned one by one and
    count as one repository. An empty table gives an empty result. Other columns
    are ignored. Values leave the scan only as hashes.
    """
    rows = docs.select(
        docs[id_col].alias("_id"), F.coalesce(docs[owner_col].cast("string"), F.lit("\0")).alias("_owner"),
        F.coalesce(docs[repo_col or id_col].cast("string"), F.lit("\0")).alias("_repo"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"),
        F.monotonically_increasing_id().alias("_row"))
    for kind, (regex, group) in enumerate(((ASSIGN, 2), (ACCESS, 0), (HEX, 0), (GENERIC, 0))):
        rows = _matches(rows, kind, regex, group)
    none = F.array().cast(f"array<{_HIT}>")
    hits = F.concat(*[F.coalesce(F.col(f"_hits{k}"), none) for k in range(len(KINDS))])
    # one row per match, and one for a document without any; no text goes further
    flat = rows.select("_row", "_id", "_owner", "_repo", F.explode_outer(hits).alias("h"))
    flat = write_table(flat.select("_row", "_id", "_owner", "_repo", "h.kind", "h.idx", "h.pre", "h.len",
                                   F.length("h.value").alias("n"), F.sha2("h.value", 256).alias("value_hash"),
                                   (F.col("h.value").rlike("[0-9]") & F.col("h.value").rlike("[A-Z]")
                                    & F.col("h.value").rlike("[a-z]")).alias("mixed")), "secret-hits")

    in_text = Window.partitionBy("_row", "kind").orderBy("idx")
    end = F.sum(F.col("pre") + F.col("len")).over(in_text)
    found = (flat.where("kind is not null").withColumn("end", end.cast("int"))
             .withColumn("start", F.col("end") - F.col("len"))
             .where((F.col("kind") != 0) | (F.col("n") >= MIN_ASSIGN))
             .where((F.col("kind") < len(BASE_KINDS)) | F.col("mixed")))
    # written, so that the rows of a value that stands everywhere can be split
    spread = write_table(found.groupBy("value_hash", "_owner", "_repo").agg(F.lit(1).alias("one"))
                         .groupBy("value_hash", "_owner").agg(F.count("*").alias("repos"))
                         .groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos")), "secret-spread")
    live = (F.col("n_owners") < wide_owners) & (F.col("n_repos") < wide_repos)
    known = found.join(spread, "value_hash").withColumn("looks_live", live)
    # a generic span overlaps a base span if one that starts before its end ends after its start:
    # one pass over the spans of a text by these positions
    base = F.col("kind") < len(BASE_KINDS)
    position = F.when(base, F.col("start") * 2).otherwise(F.col("end") * 2 - 1)
    before = Window.partitionBy("_row").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(base, F.col("end"))).over(before)
    kept = known.withColumn("at", position).withColumn("reach", F.coalesce(reach, F.lit(-1))).where(
        base | (F.col("looks_live") & (F.col("reach") <= F.col("start"))))
    spans = kept.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind", "end", "value_hash", "n_owners", "n_repos", "looks_live"))).alias("spans"))
    every = flat.where("idx is null or (idx = 0)").groupBy("_row").agg(F.first("_id").alias("_id"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return every.join(spans, "_row", "left").select(F.col("_id").alias(id_col), F.coalesce("spans", empty).alias("spans"))
