"""Importance resampling towards a target distribution by hashed n-grams (operator 12).

Texts are lower-cased (A-Z only) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  The
position table has a row per word (``posexplode``); ``lead`` over a document's positions concatenates
the words that follow for each order, and the CRC-32 of the result is its bucket.  The table is written
once with a bucket column per order.  Buckets are counted over the corpus and over the target, which
gives a gain per bucket; gains are joined to the table and their floored mean is a document's weight.  Gumbel noise
seeded by the doc_id makes a draw without replacement out of the order of weight plus noise.

Texts are shuffled before they are cut, on (doc_id, salt): windows over positions and sums per document then need no
shuffle of words, and the rows stand in their order already.

Defined results: a null or wordless text has no feature, weight 0, and is not drawn.  A null doc_id is
hashed as an empty string and comes last among ties.  Repeated rows are rows of their own.  Where the target holds nothing, gains
follow the formula with t = T = 0.  Extra columns are ignored.  An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import Workspace, join_checked

ORDERS = 2
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def position_table(docs: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, row and a bucket f1, f2, ... per order for every word; one row without buckets for texts without words.

    ``row`` tells rows of one doc_id apart.  Null doc_ids are dealt out by their text.
    """
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    dealt = docs.select("doc_id", salt.alias("salt"), "text").repartition("doc_id", "salt")
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    words = dealt.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", "salt", F.posexplode_outer(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))).alias("at", "word")
    )
    along = W.partitionBy("row", "doc_id", "salt").orderBy("at")
    for k in range(1, orders):
        words = words.withColumn(f"then{k}", F.lead("word", k).over(along))
    gram, out = F.col("word"), []
    for k in range(orders):
        gram = F.concat(gram, F.lit(" "), F.col(f"then{k}")) if k else gram  # null where the text ends
        out.append((F.crc32(gram.cast("binary")) % buckets).cast("int").alias(f"f{k + 1}"))
    return words.select("doc_id", "row", *out)


def _grams(table: DataFrame, *keep: str) -> DataFrame:
    orders = sorted(c for c in table.columns if c not in ("doc_id", "row"))
    return table.select(*keep, F.explode_outer(F.array(*orders)).alias("bucket"))


def gains(corpus: DataFrame, target: DataFrame, space: Workspace, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket of the corpus; at most ``buckets`` rows."""
    count = lambda table: _grams(table).filter("bucket is not null").groupBy("bucket").agg(F.count("*").alias("n"))
    ours, theirs = space.table(count(corpus), "ours"), space.table(count(target), "theirs")
    size = lambda table: float(table.agg(F.sum("n")).first()[0] or 0)
    all_ours, all_theirs = size(ours), size(theirs)
    both = ours.join(F.broadcast(theirs.select(F.col("bucket").alias("_bucket"), F.col("n").alias("t"))), F.col("bucket") == F.col("_bucket"), "left")
    t, s = F.coalesce("t", F.lit(0)).cast("double") + 1, F.col("n").cast("double") + 1
    ratio = (t * F.lit(all_ours + buckets)) / (s * F.lit(all_theirs + buckets))
    return space.table(both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain")), "gains")


def _floor_div(a: Column, b: Column) -> Column:
    """Floored quotient of whole numbers, exactly."""
    return F.call_function("div", a - F.pmod(a, b), b)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise, floored, from the digest of seed and doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row; rank is null for those not drawn."""
    space = Workspace(docs.sparkSession, "importance")
    table = space.table(position_table(docs), "positions")
    benchmark = space.table(position_table(target.select(F.lit(None).cast("long").alias("doc_id"), "text")), "target")
    gain = gains(table, benchmark, space)
    met = _grams(table, "doc_id", "row").join(F.broadcast(gain), "bucket", "left")
    scored = met.groupBy("doc_id", "row").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("total"))
    weight = F.when(F.col("n_features") > 0, _floor_div(F.col("total"), F.greatest("n_features", F.lit(1)))).otherwise(F.lit(0)).cast("long")
    scored = scored.select("doc_id", "row", "n_features", weight.alias("weight")).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    scored = space.table(scored, "scored")
    space.drop("positions", "target")
    # a text of n words has n + (n - 1) + ... features
    able = F.col("n_features") >= sum(min_words - k for k in range(ORDERS))
    # Ranks: how many have a higher score, from counts per score (some ten thousand values), then the place among equals.
    counts = space.table(scored.filter(able).groupBy("score").agg(F.count("*").alias("n")), "counts")
    most = (counts.agg(F.sum("n")).first()[0] or 0) * percent // 100
    above = counts.withColumn("above", F.coalesce(F.sum("n").over(W.orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    above = space.table(above.filter(F.col("above") < most).select(F.col("score").alias("_score"), "above"), "above")
    placed = join_checked(scored.withColumn("_able", able), above, [("score", "_score")], "left")
    out = [F.col(c) for c in ("doc_id", "n_features", "weight", "score")]
    near = placed.filter("_able and above is not null")
    place = F.col("above") + F.row_number().over(W.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "row"))
    drawn = near.select(*out, F.when(place <= most, place).cast("long").alias("rank"))
    return drawn.unionByName(placed.filter("not _able or above is null").select(*out, F.lit(None).cast("long").alias("rank")))


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text"))


#: CRC-32 by its table of 256 remainders, over the bytes of each distinct feature.
ORACLE = r"""
with recursive tb(i, r, k) as (select i::bigint, i::bigint, 0 from range(256) x(i)
  union all select i, case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end, k + 1 from tb where k < 8),
tl as (select list(r order by i) as t from tb where k = 8),
x as (select 'd' as side, doc_id, coalesce(text, '') as text from documents union all select 'b', row_number() over (), coalesce(text, '') from benchmark),
w as (select side, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from x),
f as (select side, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as g from w),
n as (select side, doc_id, g, count(*) as n from f group by all),
u as (select g, list_transform(range(1, (length(hex(encode(g))) // 2 + 1)::bigint), lambda i: ('0x' || substring(hex(encode(g)), 2 * i - 1, 2))::bigint) as bytes from (select distinct g from n)),
h as (select g, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 as bucket from u, tl),
m as (select side, doc_id, bucket, sum(n) as n from n join h on n.g = h.g group by all),
s as (select bucket, sum(n)::double as s from m where side = 'd' group by bucket),
t as (select bucket, sum(n)::double as t from m where side = 'b' group by bucket),
z as (select coalesce((select sum(s) from s), 0) as zs, coalesce((select sum(t) from t), 0) as zt),
a as (select s.bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (zs + 10000) / ((s + 1) * (zt + 10000))))::bigint as gain from s left join t on s.bucket = t.bucket, z),
c as (select doc_id, sum(n)::bigint as n_features, sum(n * gain)::bigint as total from m join a on m.bucket = a.bucket where side = 'd' group by doc_id),
e as (select d.doc_id, coalesce(n_features, 0) as n_features, case when n_features > 0 then (total - ((total % n_features) + n_features) % n_features) // n_features else 0 end::bigint as weight,
             ('0x' || substring(sha256('7:' || d.doc_id), 1, 8))::bigint as h from documents d left join c on d.doc_id = c.doc_id),
v as (select doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from e),
r as (select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from v where n_features >= 39)
select v.doc_id, n_features::bigint as n_features, weight, score, rank from v left join r on v.doc_id = r.doc_id and rank <= 25 * n // 100
"""
