"""Secrets in texts, told apart by who else has them. DataFrame functions only.

Patterns find candidates. The hash of every candidate value is counted over the
corpus by distinct owners and repositories: a value that many owners have is a
copied example, one that few have looks like a live credential. Base patterns
always report; candidates of the wide pattern are added only if owner-specific.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.fingerprint import let
from clickloom.operators.lookup import left_lookup
from clickloom.session import cut_lineage

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: (kind, pattern, group of the value, fewest characters of the value). A
#: maximal run below its minimum fails whole, so the minimum may stand in the
#: pattern; an assignment with a short value must still use up its characters.
BASE = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
OWNED = ("owned", r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
KINDS = (*BASE, OWNED)
#: Copies of a document take its secrets to some more owners.
FEW_OWNERS = 8
ROWS_PER_SALT = 2_000
BLOCK = 256


def running_sums(values: Column) -> Column:
    """0 and the sums of the first 1, 2, .. values; in blocks, so that the cost
    of a long array stays far from its square."""

    def cumulate(xs: Column) -> Column:
        start = F.array(F.lit(0))
        return F.aggregate(
            xs, start, lambda sums, x: F.concat(sums, F.array(F.get(sums, F.size(sums) - 1) + x))
        )

    def of(xs: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int"))
        blocks = F.when(
            F.size(xs) > 0,
            F.transform(numbers, lambda b: F.slice(xs, b * BLOCK + 1, BLOCK)),
        ).otherwise(F.array().cast("array<array<int>>"))
        totals = F.transform(
            blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x)
        )

        def place(heads: Column) -> Column:
            inner = F.transform(
                blocks,
                lambda block, b: F.transform(
                    F.slice(cumulate(block), 2, F.size(block)),
                    lambda x: x + F.get(heads, b),
                ),
            )
            return F.concat(F.array(F.lit(0)), F.flatten(inner))

        return let(cumulate(totals), place)

    return let(values, of)


def spans_of(text: Column, number: int) -> Column:
    """Leftmost matches of a kind that do not overlap, as (start, kind, end,
    value) in code points; those with a short value are left out."""
    _, pattern, group, least = KINDS[number]
    fields = "array<struct<start:int,kind:int,end:int,value:string>>"

    def of(hits: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        sizes = F.transform(hits, F.length)
        steps = F.zip_with(gaps, sizes, lambda gap, size: gap + F.coalesce(size, F.lit(0)))

        def put(ends: Column) -> Column:
            return F.transform(
                hits,
                lambda hit, i: F.struct(
                    (F.get(ends, i + 1) - F.get(sizes, i)).alias("start"),
                    F.lit(number).alias("kind"),
                    F.get(ends, i + 1).alias("end"),
                    F.regexp_extract(hit, pattern, group).alias("value"),
                ),
            )

        return F.filter(let(running_sums(steps), put), lambda s: F.length(s["value"]) >= least)

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)
    return F.when(text.rlike(pattern), found).otherwise(F.array()).cast(fields)


def looks_random(value: Column) -> Column:
    """Lower and upper case letters and digits together."""
    return value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")


def candidates(docs: DataFrame, owner: str, repository: list[str]) -> DataFrame:
    """(row, doc_id, base, wide, owner, repository), stored once.

    ``row`` numbers the rows, whatever their ids. ``wide`` has the random-looking
    matches of the wide pattern that touch no base span.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.sort_array(F.concat(*[spans_of(F.col("text"), k) for k in range(len(BASE))]))

    def free(span: Column) -> Column:
        return looks_random(span["value"]) & ~F.exists(
            "base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"])
        )

    rows = (
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            text.alias("text"),
            F.col(owner).cast("string").alias("owner"),
            F.struct(*[F.col(c).cast("string") for c in repository]).alias("repository"),
        )
        .withColumn("base", base)
        .withColumn("wide", F.filter(spans_of(F.col("text"), len(BASE)), free))
    )
    return cut_lineage(rows.drop("text"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories) of every candidate value; null owners count
    as one. Rows are made distinct before each shuffle."""
    pairs = found.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories")
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(name) for name, *_ in KINDS])
    each = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    )
    return F.array_join(each, ",")


def scan_documents(
    docs: DataFrame,
    owner: str = "source",
    repository: tuple[str, ...] = ("source", "lang"),
    few_owners: int = FEW_OWNERS,
) -> DataFrame:
    """One row per document: its base matches, all spans and how many are live.

    ``n_live`` counts reported spans whose value has at most ``few_owners``
    distinct owners, ``n_shared`` the others; ``live_spans`` names the former.
    Null texts count as empty: no spans, the digest of nothing. Repeated or null
    ids keep their rows, a null owner or repository counts as one more; other
    columns are not looked at.
    """
    stored = candidates(docs, owner, list(repository))
    span = F.explode(F.concat("base", "wide"))
    found = stored.select("row", "owner", "repository", span.alias("span")).withColumn(
        "hash", F.xxhash64("span.value")
    )
    judged = left_lookup(
        found.select("row", "span", "hash"),
        ownership(found),
        ["hash"],
        small=False,
        rows_per_salt=ROWS_PER_SALT,
    )
    live = F.col("owners") <= few_owners
    spans = (
        judged.filter(live | (F.col("span.kind") < len(BASE)))
        .groupBy("row")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("span.start", "span.kind", "span.end", live.alias("live"))
                )
            ).alias("spans")
        )
    )
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean>>")
    every = F.coalesce("spans", nothing)
    out = stored.join(spans, "row", "left").withColumn("spans", every)

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)]
    only_live = F.filter("spans", lambda s: s["live"])
    return out.select(
        "doc_id",
        *counts,
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        F.size(only_live).cast("long").alias("n_live"),
        (F.size("spans") - F.size(only_live)).cast("long").alias("n_shared"),
        spans_text(only_live).alias("live_spans"),
        spans_text(F.col("spans")).alias("spans"),
    )
