"""Benchmark passages in documents, also with other numbers, names and units.

Texts become templates: a number, a unit after a number and a capitalised word inside
a sentence give way to a placeholder of their type; other words are lower-cased.
Windows of ``n`` template tokens of the benchmark are joined by hash with those of
the documents; a window with fewer than ``LEAST_LITERALS`` literal tokens says too
little as a template and is joined by its template and its values together.  Along one
alignment of a document and an item each item value stands for one document value,
the one in most places (the smaller of two in equally many).  A window with the item's
own values counts; one with other values counts when all of them are such values.  Two
item values may have become the same.

All of it is DataFrame functions.  The benchmark side is counted first and broadcast
only when it has at most ``BROADCAST_WINDOWS`` windows (a few dozen bytes each);
beyond that both sides are shuffled by the hash of the window.  Benchmark windows are
grouped by their hash before the join, so a document's window meets one row.

Defined results: a null or empty text has no windows; an item of fewer tokens than a
window is matched by its whole template, and by nothing if fewer than
``LEAST_LITERALS`` of its tokens (and not all) are literal; a null doc_id or item_id is
an id like any other; rows that share an id are one document or item; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, step, table, unused, with_row_key

WINDOW, LEAST_LITERALS = 8, 4
#: Windows of an item, and their share, that make a document contaminated: either is enough.
LEAST_MATCHED, LEAST_SHARE = 6, 0.5
BROADCAST_WINDOWS = 1_000_000

#: Marks put before names and units, from the private-use area.
NAME, UNIT = "\ue000", "\ue001"
UNITS = "km|m|cm|mm|kg|g|mg|l|ml|mph|kmh|s|ms|min|h|hours|days|years|miles|feet|inches|pounds|dollars|euros|percent"
TOKEN = rf"[{NAME}{UNIT}]?[\p{{L}}\p{{M}}]+|[0-9]+(?:[.,][0-9]+)*"


def tokens(text: Column) -> Column:
    """Words and numbers of a text; names and units carry their mark."""
    marked = F.regexp_replace(text, r"(\p{Ll}[,;]? )(\p{Lu})", f"$1{NAME}$2")
    marked = F.regexp_replace(marked, rf"([0-9]) ?({UNITS})([^\p{{L}}\p{{N}}]|$)", f"$1 {UNIT}$2$3")
    return F.regexp_extract_all(marked, F.lit(TOKEN), F.lit(0))


def is_slot(token: Column) -> Column:
    return (token < ":") | token.startswith(NAME) | token.startswith(UNIT)


def template(found: Column) -> Column:
    """Tokens with placeholders in place of slot values."""
    return F.transform(
        found,
        lambda x: F.when(x < ":", F.lit("<number>"))
        .when(x.startswith(NAME), F.lit("<name>"))
        .when(x.startswith(UNIT), F.lit("<unit>"))
        .otherwise(F.lower(x)),
    )


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once per row."""
    return F.transform(F.array(value), body)[0]


def windows(rows: DataFrame, key: str, text: str, n: int, whole: bool) -> DataFrame:
    """Per window: the key, the position, the hash it is joined by, its slot values, and
    whether it is a short text of too few literals.  With ``whole`` a shorter text is one
    window."""
    size = F.lit(n)

    def cut(found: Column) -> Column:
        span = F.least(size, F.size(found)) if whole else size

        def one(shape: Column, i: Column, slots: Column | None) -> Column:
            part = F.slice(shape, i, span)
            literals = span if slots is None else span - F.size(slots)
            by_template, scarce = F.xxhash64(part), literals < F.least(F.lit(LEAST_LITERALS), span)
            return F.struct(
                i.alias("at"),
                (by_template if slots is None else F.when(scarce, F.xxhash64(part, slots)).otherwise(by_template)).alias("h"),
                (F.lit(None).cast("array<string>") if slots is None else slots).alias("slots"),
                (scarce & (span < size)).alias("vague"),
                span.alias("n"),
            )

        def all_of(shape: Column) -> Column:
            places = F.sequence(F.lit(1), F.size(found) - span + 1)
            plain = F.transform(places, lambda i: one(shape, i, None))
            return F.when(
                F.exists(found, is_slot),
                F.transform(places, lambda i: let(F.filter(F.slice(found, i, span), is_slot), lambda s: one(shape, i, s))),
            ).otherwise(plain)

        return F.when(F.size(found) >= (1 if whole else n), let(template(found), all_of))

    cuts = F.explode(let(tokens(F.coalesce(F.col(text).cast("string"), F.lit(""))), cut)).alias("w")
    return rows.select(F.col(key).cast("bigint").alias(key), cuts).select(key, "w.*")


def benchmark_windows(items: DataFrame, item_id: str, text: str, n: int) -> DataFrame:
    """Windows of the items, and how many each item has."""
    made = windows(items, item_id, text, n, whole=True).withColumnRenamed(item_id, "item_id")
    made = made.where(~F.col("vague")).dropDuplicates(["item_id", "at", "h"])
    total = made.groupBy("item_id").agg(F.count("*").alias("n_windows"))
    both = made.alias("w").join(total.alias("t"), F.expr("w.item_id <=> t.item_id"))
    return both.select("w.item_id", "w.at", "w.h", "w.slots", "w.n", "t.n_windows")


def agreeing(hits: Column) -> Column:
    """The windows of one alignment whose values are the item's own or agree with most."""

    def differs(pair: Column) -> Column:
        return pair["i"] != pair["d"]

    def chosen(pairs: Column) -> Column:
        """Of the value pairs the one in most places for each item value."""
        counts = F.transform(
            F.array_distinct(pairs), lambda p: F.struct(p.alias("p"), F.size(F.filter(pairs, lambda q: q == p)).alias("n"))
        )

        def best(all_: Column) -> Column:
            def beaten(a: Column) -> Column:
                def better(b: Column) -> Column:
                    tie = (b["n"] == a["n"]) & (b["p"]["d"] < a["p"]["d"])
                    return (b["p"]["i"] == a["p"]["i"]) & ((b["n"] > a["n"]) | tie)

                return F.exists(all_, better)

            return F.transform(F.filter(all_, lambda a: ~beaten(a)), lambda a: a["p"])

        return let(counts, best)

    def fits(hit: Column, good: Column) -> Column:
        return ~F.exists(hit["pairs"], differs) | F.forall(hit["pairs"], lambda p: F.array_contains(good, p))

    kept = let(chosen(F.flatten(hits["pairs"])), lambda good: F.filter(hits, lambda h: fits(h, good)))
    return F.when(F.exists(hits, lambda h: F.exists(h["pairs"], differs)), kept).otherwise(hits)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    doc_text: str = "text",
    item_text: str = "text",
    n: int = WINDOW,
) -> DataFrame:
    """Per contaminated document and item: windows matched, windows of the item, the
    share, whether slots differ (``exact`` or ``reparameterised``), slot values
    changed, and the first matching token of the document."""
    bench = step(benchmark_windows(items, item_id, item_text, n), "benchmark_windows")
    sizes = bench.agg(F.count("*"), F.collect_set("n")).first()  # at most `n` different sizes
    entry = F.struct("item_id", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), "n_windows")
    by_hash = bench.groupBy("h", "n").agg(F.collect_list(entry).alias("entries"))
    if sizes[0] <= BROADCAST_WINDOWS:
        by_hash = F.broadcast(by_hash)
    hits = None
    for size in sorted({n, *sizes[1]}):
        own = windows(docs, doc_id, doc_text, size, whole=False).select(F.col(doc_id).alias("doc_id"), "at", "h", "slots", "n")
        found = own.join(by_hash, ["h", "n"]).select("doc_id", "at", "slots", F.explode("entries").alias("e"))
        hits = found if hits is None else hits.unionByName(found)
    pairs = F.coalesce(F.arrays_zip(F.col("e.item_slots").alias("i"), F.col("slots").alias("d")), F.array().cast("array<struct<i:string,d:string>>"))
    hits = hits.select("doc_id", "at", "e.item_id", "e.item_at", "e.n_windows", (F.col("at") - F.col("e.item_at")).alias("line"), pairs.alias("pairs"))
    along = hits.groupBy("doc_id", "item_id", "line").agg(
        F.max("n_windows").alias("n_windows"), F.collect_set(F.struct("item_at", "pairs")).alias("hits")
    )
    counted = along.withColumn("hits", let(F.col("hits"), agreeing)).where(F.size("hits") > 0)
    changed = F.filter(F.array_distinct(F.flatten("hits.pairs")), lambda p: p["i"] != p["d"])
    whole = counted.groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits.item_at")))).cast("bigint").alias("n_matched"),
        F.max("n_windows").alias("n_windows"),
        F.sum(F.size(changed)).cast("bigint").alias("n_changed"),
        (F.min(F.array_min("hits.item_at") + F.col("line")) - 1).cast("bigint").alias("first_token"),
    )
    enough = (F.col("n_matched") >= LEAST_MATCHED) | (F.col("n_matched") >= LEAST_SHARE * F.col("n_windows"))
    return whole.where(enough).select(
        "doc_id",
        "item_id",
        "n_matched",
        "n_windows",
        (F.col("n_matched") / F.col("n_windows")).alias("share"),
        F.when(F.col("n_changed") > 0, "reparameterised").otherwise("exact").alias("kind"),
        "n_changed",
        "first_token",
    )


def clean_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that hold no benchmark passage, each judged by itself, whatever its id."""
    key = unused(docs, "_row")
    rows = with_row_key(docs, key, doc_id)
    found = contaminated(rows, items, key, doc_text=text).select(F.col("doc_id").alias(key)).distinct()
    return rows.join(found, key, "left_anti").select(docs.columns)


def _sql_windows(source: str, key: str) -> str:
    marked = (
        rf"regexp_replace(regexp_replace(coalesce(text, ''), '(\p{{Ll}}[,;]? )(\p{{Lu}})', '\1{NAME}\2', 'g'), "
        rf"'([0-9]) ?({UNITS})([^\p{{L}}\p{{N}}]|$)', '\1 {UNIT}\2\3', 'g')"
    )
    slot = f"(x < ':' OR x[1] IN ('{NAME}', '{UNIT}'))"
    return f"""
  SELECT {key}, i, ts[i:i + {WINDOW - 1}] AS raw,
    list_transform(ts[i:i + {WINDOW - 1}], lambda x: CASE WHEN x < ':' THEN '<number>' WHEN x[1] = '{NAME}' THEN '<name>'
      WHEN x[1] = '{UNIT}' THEN '<unit>' ELSE lower(x) END) AS shape,
    list_filter(ts[i:i + {WINDOW - 1}], lambda x: {slot}) AS slots
  FROM (SELECT {key}, ts, unnest(generate_series(1, len(ts) - {WINDOW - 1})) AS i
    FROM (SELECT {key}, regexp_extract_all({marked}, '{TOKEN}') AS ts FROM {source}))"""


#: For benchmarks whose items have a window at least.
SQL = f"""
WITH b AS MATERIALIZED ({_sql_windows("benchmark", "item_id")}
), t AS (SELECT item_id, count(*) AS n_windows FROM b GROUP BY item_id
), d AS MATERIALIZED ({_sql_windows("documents", "doc_id")}
), hits AS MATERIALIZED (
  SELECT d.doc_id, b.item_id, d.i AS pos, b.i AS item_pos, d.i - b.i AS line, b.slots AS bs, d.slots AS ds
  FROM d JOIN b ON d.shape = b.shape
  WHERE len(b.slots) <= {WINDOW - LEAST_LITERALS} OR b.slots = d.slots
), pairs AS (
  SELECT doc_id, item_id, line, pos, unnest(bs) AS v, unnest(ds) AS w FROM hits
), chosen AS (
  SELECT doc_id, item_id, line, v, w FROM pairs GROUP BY doc_id, item_id, line, v, w
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, line, v ORDER BY count(*) DESC, w) = 1
), bad AS (
  SELECT DISTINCT doc_id, item_id, line, pos FROM pairs ANTI JOIN chosen USING (doc_id, item_id, line, v, w)
), good AS MATERIALIZED (
  SELECT h.* FROM hits h LEFT JOIN (SELECT *, true AS is_bad FROM bad) USING (doc_id, item_id, line, pos) WHERE bs = ds OR is_bad IS NULL
), odd AS (
  SELECT doc_id, item_id, count(DISTINCT (line, v, w)) AS changed FROM (
    SELECT doc_id, item_id, line, unnest(bs) AS v, unnest(ds) AS w FROM good) WHERE v <> w GROUP BY ALL
), whole AS (
  SELECT doc_id, item_id, count(DISTINCT item_pos) AS n_matched, CAST(coalesce(max(changed), 0) AS BIGINT) AS n_changed, min(pos) - 1 AS first_token
  FROM good LEFT JOIN odd USING (doc_id, item_id) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_matched, n_windows, n_matched / n_windows AS share,
  CASE WHEN n_changed > 0 THEN 'reparameterised' ELSE 'exact' END AS kind, n_changed, CAST(first_token AS BIGINT) AS first_token
FROM whole JOIN t USING (item_id) WHERE n_matched >= {LEAST_MATCHED} OR n_matched >= {LEAST_SHARE} * n_windows
"""


@query("op3_decontamination", SQL)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
