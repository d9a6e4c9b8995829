"""Secret scans with corpus-wide ownership frequency (DataFrame functions only).

Each whole text is searched once per kind of credential, leftmost and without overlap. The
found values are then judged by who has them: candidate hashes are counted over the distinct
repositories and distinct owners of the whole corpus. A value that at least ``shared_owners``
owners have is a widely copied example; one that a single owner has, in few repositories, looks
like a live credential of that owner; the rest are unclear.

Defined results: a null text is empty and has no span. A span's start and end are code points,
the end exclusive. Null owners or repositories count as one owner or repository named null.
Repeated rows get equal results and add nothing to the counts. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm import common
from trendlake.llm.common import TEXT_HASH

# Kinds of credentials in their order, pattern, group of the value, its least length.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # the same as runs of [0-9a-f]+ of 24 or more
)
SHARED_OWNERS = 3
LIVE_REPOSITORIES = 2
SPAN = "array<struct<start:bigint,kind_no:int,stop:bigint,kind:string,value:string>>"


def _spans(number: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind in column t: matches and the gaps between them give the places."""
    regex = F.lit(pattern)
    whole, value = F.regexp_extract_all("t", regex, F.lit(0)), F.regexp_extract_all("t", regex, F.lit(group))
    found = F.arrays_zip(whole.alias("m"), value.alias("v"), F.split("t", pattern, -1).alias("g"))
    found = F.slice(found, F.lit(1), F.size(whole))  # the last gap has no match after it
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["g"])
        stop = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), F.lit(number).alias("kind_no"), stop.alias("stop"), F.lit(kind).alias("kind"), x["v"].alias("value"))
        more = F.when(F.length(x["v"]) >= least, F.concat(a["spans"], F.array(span).cast(SPAN))).otherwise(a["spans"])
        return F.struct(stop.cast("long").alias("at"), more.alias("spans"))

    placed = F.aggregate(found, start, step, lambda a: a["spans"])
    return F.when(F.col("t").rlike(pattern), placed).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, carry: tuple[str, ...] = ("doc_id", "source", "lang")) -> DataFrame:
    """Every document row with its ``spans``, by start, then kind."""
    df = docs.select(*carry, common.text_hash().alias(TEXT_HASH), common.whole_text().alias("t"))
    spans = F.concat(*[_spans(i, *k) for i, k in enumerate(KINDS)])
    return df.withColumn("spans", F.sort_array(spans)).drop("t")


def ownership(scanned: DataFrame, repository: Column, owner: Column, shared_owners: int = SHARED_OWNERS, live_repositories: int = LIVE_REPOSITORIES) -> DataFrame:
    """Per candidate: value_hash, n_repositories, n_owners and its verdict (example, live, unclear).

    Repositories and owners are made distinct before they are counted, with partial aggregation,
    so a value in a third of all documents arrives as one row per task, repository and owner.
    """
    each = scanned.select(
        F.struct(repository.alias("r")).alias("repository"), F.struct(owner.alias("o")).alias("owner"), F.explode("spans").alias("x")
    ).select("repository", "owner", F.sha2(F.col("x.value"), 256).alias("value_hash"))
    pairs = each.groupBy("value_hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("r"), F.sum("n").alias("n"))
    counts = owners.groupBy("value_hash").agg(
        F.sum("r").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_spans")
    )
    verdict = (
        F.when(F.col("n_owners") >= shared_owners, "example")
        .when((F.col("n_owners") == 1) & (F.col("n_repositories") <= live_repositories), "live")
        .otherwise("unclear")
    )
    return counts.withColumn("verdict", verdict)


def secret_scan(docs: DataFrame, repository: Column | None = None, owner: Column | None = None) -> DataFrame:
    """Every document row: doc_id, text hash, spans, and how many are live, example or unclear.

    In ``documents`` an owner is a source, and a repository one language section of a source.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.struct("source", "lang") if repository is None else repository
    scanned = common.materialize(scan(docs), "secrets")
    verdicts = ownership(scanned, repository, owner).select("value_hash", "verdict")
    each = (
        scanned.where(F.size("spans") > 0).select("doc_id", TEXT_HASH, "spans").distinct()
        .select("doc_id", TEXT_HASH, F.explode("spans").alias("x"))
        .select("doc_id", TEXT_HASH, F.sha2(F.col("x.value"), 256).alias("value_hash"))
    )
    per_doc = each.join(verdicts, "value_hash").groupBy("doc_id", TEXT_HASH).agg(
        *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "example", "unclear")]
    )
    d, p = scanned.alias("d"), per_doc.alias("p")
    return d.join(p, common.same_row("d", "p"), "left").select(
        "d.doc_id", f"d.{TEXT_HASH}", "d.spans",
        *[F.coalesce(f"p.n_{v}", F.lit(0).cast("long")).alias(f"n_{v}") for v in ("live", "example", "unclear")],
    )
