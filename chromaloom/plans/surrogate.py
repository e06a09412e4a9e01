"""Genome and reads derived from the tables ``documents`` and ``lineitem``, with the same in DuckDB SQL.

Every document is a contig: its letters are mapped to bases, line ends to N, the rest is left
out.  Every line item is an aligned record; order keys are query names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sites import compile_sites

SITES = compile_sites("Arima_v2")
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ\n"
BASES = "ACGTACGTACGTACGTACGTACGTAC" * 2 + "N"


def _bases(batches):
    table = bytes.maketrans(LETTERS.encode(), BASES.encode())
    other = bytes(set(range(256)) - set(LETTERS.encode()))
    for batch in batches:
        seq = [(text or b"").translate(table, other) for text in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("seq_idx"), batch.column("name"), pa.array(seq, pa.binary()).cast(pa.string())], names=["seq_idx", "name", "seq"])


def genome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq_idx, name, seq: letters and line ends mapped byte by byte.

    Texts are not shuffled here: what scans them deals out their chunks.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.select(F.col("doc_id").cast("int").alias("seq_idx"), F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("name"), "text")
    return docs.mapInArrow(_bases, "seq_idx int, name string, seq string")


def reads(spark: SparkSession, sf_dir: str, names: DataFrame | None = None) -> DataFrame:
    """line_no, qname, flag, rname, pos, mapq, cigar, rest; names: (seq_idx, name, length) if known.

    What a record needs of its line item beside the keys is packed into one number before the items are shuffled: six bits, and
    the read's length above them.  So every use shuffles the same columns, and one shuffle can serve several uses.
    """
    item = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    held = {
        1: (F.col("l_returnflag") == "R") | (F.col("l_linestatus") == "O"), 2: F.col("l_discount") >= 0.06, 4: F.col("l_discount") < 0.06, 8: F.col("l_tax") > 0.075,
        16: (F.col("l_tax") > 0.065) & (F.col("l_tax") < 0.075) & (F.col("l_linenumber") == 7), 32: F.col("l_quantity").isNull(),
    }
    packed = sum((F.when(holds, k).otherwise(0) for k, holds in held.items()), F.coalesce((10 + F.col("l_quantity")).cast("int"), F.lit(0)).cast("long") * 64)
    item = item.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", packed.alias("packed"))
    bit = lambda k: F.col("packed").bitwiseAND(k) != 0
    if names is None:
        names = genome(spark, sf_dir).select("seq_idx", F.length("seq").alias("length"))
    sizes = names.select(F.col("seq_idx").alias("s"), F.greatest("length", F.lit(1)).cast("long").alias("len"))
    total = sizes.agg(F.count("*").alias("n_seq"))
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    a = item.withColumn("rn", F.row_number().over(order)).join(F.broadcast(total))
    second = (F.col("rn") == 2) & bit(2)
    a = a.withColumn("s", F.when(second, (F.col("l_orderkey") + F.col("l_partkey")) % F.col("n_seq")).otherwise(F.col("l_orderkey") % F.col("n_seq")).cast("int"))
    near = F.when((F.col("rn") == 2) & bit(4), F.col("l_partkey") % 400).otherwise(F.lit(0))
    mapq = ((F.col("l_partkey") * 7 + F.col("l_suppkey")) % 60).cast("int")
    a = a.select("s", "l_orderkey", "rn", (F.col("l_linenumber") % 4).alias("m"), near.alias("near"), mapq.alias("mapq"), "packed")
    bits = {1: 65, 2: 129, 3: 321, 4: 1089, 5: 577, 6: 2113, 7: 69}
    flag = F.lit(0)
    for k, v in bits.items():
        flag = F.when(F.col("rn") == k, v).otherwise(flag)
    flag = (flag + F.when(bit(1), 16).otherwise(0)).cast("int")
    a = a.withColumn("flag", flag).join(sizes, "s", "left")
    rl, m = F.when(~bit(32), F.shiftright("packed", 6)), F.col("m")
    text = lambda *x: F.concat(*[y.cast("string") if not isinstance(y, str) else F.lit(y) for y in x])
    cigar = (
        F.when(bit(16), "*")
        .when(m == 0, text(rl, "M")).when(m == 1, text("5S", rl - 5, "M")).when(m == 2, text(rl - 6, "M2I4M")).otherwise(text(rl - 4, "M3D4M"))
    )
    return a.select(
        F.col("rn").cast("long").alias("line_no"), F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("qname"), "flag",
        F.when(bit(8), "chrUn").otherwise(F.concat(F.lit("doc"), F.col("s").cast("string"))).alias("rname"),
        (1 + (F.col("l_orderkey") * 7919 + F.col("near")) % F.coalesce("len", F.lit(1))).cast("long").alias("pos"),
        "mapq", cigar.alias("cigar"), F.lit("*\t0\t0\t*\t*").alias("rest"),
    )


GENOME = r"""
g as (select doc_id::int as seq_idx, 'doc' || doc_id as name,
             translate(regexp_replace(coalesce(text, ''), '[^a-zA-Z\n]', '', 'g'),
                       'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(10),
                       'ACGTACGTACGTACGTACGTACGTACACGTACGTACGTACGTACGTACGTACN') as seq
      from documents),
sq as (select seq_idx, name, length(seq)::bigint as length from g)"""

CUTS = GENOME + r""",
wi as (select seq_idx, i, substring(seq, i + 1, 5) as w from (select seq_idx, seq, unnest(range(length(seq))) as i from g)),
cu as (select seq_idx, 0::bigint as cut from g
       union select seq_idx, i from wi where w like 'GATC%'
       union select seq_idx, i + 1 from wi
       where w like 'TTAA%' or regexp_matches(w, '^GA[ACGT]TC$') or regexp_matches(w, '^CT[ACGT]AG$')
          or regexp_matches(w, '^[ATGC]N') or regexp_matches(w, '^N[ATGC]')),
fr as (select (row_number() over (order by cu.seq_idx, cut) - 1)::bigint as frag_id, cu.seq_idx, sq.name, cut as frag_start,
              lead(cut) over (partition by cu.seq_idx order by cut) as frag_next,
              coalesce(lead(cut) over (partition by cu.seq_idx order by cut), length) as frag_end
       from cu join sq on cu.seq_idx = sq.seq_idx)"""

READS = CUTS + r""",
n as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as rn,
             (select count(*) from g) as ns from lineitem),
a as (select *, case when rn = 2 and l_discount >= 0.06 then (l_orderkey + l_partkey) % ns else l_orderkey % ns end as s,
             cast(10 + l_quantity as int) as rl from n),
rd as (select rn::bigint as line_no, 'r' || l_orderkey as qname,
              (case rn when 1 then 65 when 2 then 129 when 3 then 321 when 4 then 1089 when 5 then 577 when 6 then 2113 when 7 then 69 else 0 end
               + case when l_returnflag = 'R' or l_linestatus = 'O' then 16 else 0 end)::int as flag,
              case when l_tax > 0.075 then 'chrUn' else 'doc' || s end as rname,
              (1 + (l_orderkey * 7919 + case when rn = 2 and l_discount < 0.06 then l_partkey % 400 else 0 end)
                   % coalesce(greatest(sq.length, 1), 1))::bigint as pos,
              ((l_partkey * 7 + l_suppkey) % 60)::int as mapq,
              case when l_tax > 0.065 and l_tax < 0.075 and l_linenumber = 7 then '*'
                   when l_linenumber % 4 = 0 then rl || 'M' when l_linenumber % 4 = 1 then '5S' || (rl - 5) || 'M'
                   when l_linenumber % 4 = 2 then (rl - 6) || 'M2I4M' else (rl - 4) || 'M3D4M' end as cigar
       from a left join sq on sq.seq_idx = a.s),
rl as (select *, coalesce(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]*)[MDN=X]', 1), lambda x: case when x = '' then 1 else x::bigint end)), 0)::bigint as ref_len,
              coalesce(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]*)[MIS=X]', 1), lambda x: case when x = '' then 1 else x::bigint end)), 0)::bigint as query_len
       from rd),
ca as (select rl.*, sq.seq_idx as sx, case when flag & 16 <> 0 then pos + ref_len - 2 else pos - 1 end as st,
              case when flag & 2048 <> 0 then 'SP' when flag & 1024 <> 0 then 'DP' when flag & 512 <> 0 then 'QC' when flag & 256 <> 0 then 'SE'
                   when flag & 4 <> 0 then 'UM' when flag & 1 = 0 then 'UP' when sq.seq_idx is null then 'IR' when mapq < 10 then 'MQ' end as early
       from rl left join sq on rl.rname = sq.name),
lk as (select ca.*, fr.frag_id as fi, fr.frag_start as fs, fr.frag_next as fn,
              case when fn - st < st - fs then st - fn else st - fs end as di
       from (select * from ca where early is null) ca asof left join fr on ca.sx = fr.seq_idx and ca.st >= fr.frag_start),
al as (select *, case when abs(di) < 2 * query_len then null else 'RS' end as hc from lk
       union all by name select *, early as hc from ca where early is not null),
cl as (select line_no, qname, flag, rname, pos, mapq, cigar, ref_len, query_len, hc,
              case when hc is null then sx end as seq_idx, case when hc is null then st end as read_start, case when hc is null then fi end as frag_id,
              case when hc is null then fs end as frag_start, case when hc is null then fn end as frag_next, case when hc is null then di end as site_dist
       from al),
gd as (select *, flag & 16 <> 0 as rev, flag & 64 <> 0 as one from cl where hc is null)"""

PAIRS = READS + r""",
pp as (select a.qname, a.seq_idx = b.seq_idx as intra, a.seq_idx = b.seq_idx and a.read_start > b.read_start as sw, a, b
       from gd a join gd b on a.qname = b.qname and a.one and not b.one),
ps as (select qname, intra, case when sw then b else a end as r1, case when sw then a else b end as r2 from pp),
pr as (select qname, intra,
              case when r1.frag_id = r2.frag_id then case when r1.rev and not r2.rev then 'SC' when not r1.rev and r2.rev then 'DE' else 'SS' end
                   when intra and r1.frag_next = r2.frag_start then 'RL'
                   else case when r1.rev then 'R' else 'F' end || case when r2.rev then 'R' else 'F' end end as hc,
              case when intra then r2.read_start - r1.read_start end as pair_sep,
              case when intra then case when r1.frag_next is null then 0 else r2.frag_start - r1.frag_next end end as frag_sep, r1, r2
       from ps)"""


def _found(k: int, site) -> str:
    """Matches of a site that do not overlap, by the lengths of what lies between them."""
    low, high = sorted((site.loc, site.rev_loc))
    side = (site.loc < site.rev_loc) - (site.rev_loc < site.loc)
    return f"""
       union all select seq_idx, spot + {site.loc}, {k + 2}, i, {side}, substring(seq, spot + {low} + 1, {high - low}) from (
         select seq_idx, seq, i, n, (sum(length(p)) over (partition by seq_idx order by i) + (i - 1) * {site.width})::bigint as spot from (
           select seq_idx, seq, unnest(ps) as p, generate_subscripts(ps, 1) as i, len(ps) as n from (select seq_idx, seq, regexp_split_to_array(seq, '{site.pattern}') as ps from g))) where i < n"""


DIGEST = GENOME + r""",
mt(seq_idx, spot, o, i, side, hang) as (select seq_idx, 0::bigint, 0, 0, 0, '' from g
       union all select seq_idx, length(seq)::bigint, 1, 0, 0, '' from g""" + "".join(_found(k, s) for k, s in enumerate(sorted(SITES, key=lambda s: (s.pattern, s.loc)))) + r"""),
ft as (select seq_idx, spot as a, side as s, hang as h, lead(spot) over w as b, lead(side) over w as t, lead(hang) over w as e from mt window w as (partition by seq_idx order by spot, o, i)),
ad as (select g.seq_idx, name, a as frag_start, b as frag_end, length(h)::int as front, s < 0 as front_fwd, length(e)::int as "end", t > 0 as end_fwd,
              name || '_' || a || '_' || length(h) || case when s < 0 then '+' else '-' end || '_' || length(e) || case when t > 0 then '+' else '-' end as frag_name,
              case when s < 0 then h else '' end || substring(seq, a + 1, b - a) || case when t > 0 then e else '' end as bases
       from ft join g on ft.seq_idx = g.seq_idx where b is not null)"""

#: Bases and qualities of a read, so that a slice shows where it was cut.
SEQ, QUAL = "ACGTTGCAACTG" * 8, "ABCDEFGHIJKL" * 8
PHRED = "!+5AI?./0FJ#" * 8

TRIM = DIGEST + READS.removeprefix(GENOME) + rf""",
fg as (select seq_idx, frag_start, frag_name, length(bases)::bigint as len, front, front_fwd, "end" as back, end_fwd, case when front_fwd then front else 0 end as filled from ad where frag_end > frag_start),
pl as (select rl.line_no, rl.qname, rl.flag, rl.cigar, rl.query_len, rl.pos, sq.seq_idx, case when rl.pos > 0 then least(rl.pos, sq.length) - 1 end as spot
       from rl left join sq on rl.rname = sq.name where rl.flag & 2304 = 0),
hd as (select pl.*, fg.* exclude (seq_idx), fg.seq_idx is not null as held from pl asof left join fg on pl.seq_idx = fg.seq_idx and pl.spot >= fg.frag_start),
sz as (select * exclude (pos), case when held then pos - frag_start + filled else pos end as pos,
              case when (flag & 16 <> 0) = front_fwd then 0 else front end as f, case when (flag & 16 <> 0) = end_fwd then 0 else back end as e,
              substring('{SEQ}', (1 + line_no % 12)::int, query_len::int) as seq, substring('{QUAL}', (1 + line_no % 12)::int, query_len::int) as qual from hd),
op as (select line_no, qname, i, k, n, sum(n) over (partition by line_no, qname order by i) - n as b from (
         select line_no, qname, unnest(ks) as k, generate_subscripts(ks, 1) as i, unnest(list_transform(ns, lambda x: case when x = '' then 1 else x::bigint end)) as n from (
           select line_no, qname, regexp_extract_all(cigar, '([0-9]*)[MIDNSHPX=]', 1) as ns, regexp_extract_all(cigar, '[0-9]*([MIDNSHPX=])', 1) as ks from sz))),
ld as (select line_no, qname, coalesce(min(b) filter (where k in ('M', 'D', 'N', '=', 'X')), sum(n)) as lead from op group by all),
sk as (select sz.*, greatest(coalesce(lead, 0) + f - (pos - 1), 0) as skip from sz left join ld on sz.line_no = ld.line_no and sz.qname = ld.qname),
kp as (select *, greatest(greatest(greatest(len - f, 0) - e, 0) - case when skip > 0 then 0 else pos - 1 - f end, 0) as keep from sk),
cl2 as (select op.line_no, op.qname, i, k, k in ('M', 'I', 'S', '=', 'X') as query, least(greatest(skip - b, 0), n) as cut,
               case when skip - b > n then 0 else least(n - least(greatest(skip - b, 0), n), greatest(keep - greatest(b - skip, 0), 0)) end as taken, n
        from op join kp on op.line_no = kp.line_no and op.qname = kp.qname),
cs as (select line_no, qname, sum(case when query then cut else 0 end) as head, sum(case when query then n - cut - taken else 0 end) as tail,
              coalesce(string_agg(taken::bigint || k, '' order by i) filter (where taken > 0), '') as cg from cl2 group by all),
td as (select kp.line_no, kp.qname, held and pos > 0 and cigar <> '*' as known, keep, query_len - coalesce(head, 0) - coalesce(tail, 0) as left_bases, cigar, coalesce(cg, '') as cg, coalesce(head, 0) as head, seq, qual
       from kp left join cs on kp.line_no = cs.line_no and kp.qname = cs.qname)"""

#: Histograms with equal counts and the models fitted to them, as contact_models gives them.
MODELS = PAIRS + r""",
dd as (select lower(hc) as class, pair_sep as dis from pr where intra and hc in ('FF', 'FR', 'RF', 'RR')),
rk as (select dis, row_number() over (order by dis) - 1 as r from dd),
st as (select count(*) as n, min(dis) as lo, max(dis) as hi, quantile_cont(dis, 0.25) as q1, quantile_cont(dis, 0.75) as q3 from dd),
bc as (select n, hi, case when hi > lo then least(greatest(ceil((hi - lo) / greatest(least((hi - lo) / (log2(n) + 1), greatest(2 * (q3 - q1) / pow(n, 1.0::double / 3), (hi - lo) / sqrt(n) / 2)), 1)), 1), 1024) else 1 end::bigint as bins from st),
kk as (select n, hi, bins, unnest(range(bins + 1)) as k from bc),
sp as (select *, (n * k)::double / bins as spot from kk),
eg as (select k, bins, case when spot < n - 1 then a.dis + (b.dis - a.dis) * (spot - floor(spot)) else hi::double end as edge
       from sp left join rk a on a.r = floor(spot) left join rk b on b.r = floor(spot) + 1),
eu as (select edge, bins, max(k) as k from eg group by edge, bins),
pb as (select class, least(k, bins - 1) as bin from dd asof join eu on dd.dis >= eu.edge),
hb as (select bin, count(*) as n, count_if(class = 'ff') as ff, count_if(class = 'fr') as fr, count_if(class = 'rf') as rf, count_if(class = 'rr') as rr from pb group by bin),
tb as (select x.k, (x.edge + y.edge) / 2 as sep, coalesce(hb.n, 0)::double as n, coalesce(hb.n, 0)::double / nullif(y.edge - x.edge, 0) / greatest((select n from bc), 1) as density,
              coalesce(ff, 0) as ff, coalesce(fr, 0) as fr, coalesce(rf, 0) as rf, coalesce(rr, 0) as rr
       from eg x join eg y on y.k = x.k + 1 left join hb on hb.bin = x.k),
hi as (select sep, density as prob, 'all' as class from tb
       union all select sep, density / nullif(n, 0) * ff, 'ff' from tb union all select sep, density / nullif(n, 0) * fr, 'fr' from tb
       union all select sep, density / nullif(n, 0) * rf, 'rf' from tb union all select sep, density / nullif(n, 0) * rr, 'rr' from tb),
hh as (select * from hi where class = 'all' or class in (select class from dd)),
xy as (select class, ln(sep) as x, ln(prob) as y from hh where sep > 1000 and sep < 7000000 and prob > 0),
ce as (select class, count(*) as n, avg(x) as mx, avg(y) as my, avg(y + x) as i1, avg(y + 0.5 * x) as m1 from xy group by class),
mo as (select xy.class, n, my, i1, m1, mx, sum((x - mx) ** 2) as s2, sum((x - mx) ** 3) as s3, sum((x - mx) ** 4) as s4, sum((x - mx) * (y - my)) as t1, sum((x - mx) ** 2 * (y - my)) as t2
       from xy join ce on xy.class = ce.class group by all),
co as (select *, n * (s2 * s4 - s3 * s3) - s2 * s2 * s2 as det, t1 / s2 as slope from mo),
cf as (select *, -s2 * (s2 * t2 - s3 * t1) / det as a2, (n * (t1 * s4 - s3 * t2) - s2 * s2 * t1) / det as b2, n * (s2 * t2 - s3 * t1) / det as c2 from co),
pd as (select xy.class, n, x, y, case when n > 1 then my end as p0, case when n > 1 then my + slope * (x - mx) end as p1, case when n > 1 then my + a2 + b2 * (x - mx) + c2 * (x - mx) ** 2 end as p2, i1 - x as pi, m1 - 0.5 * x as pm from xy join cf on xy.class = cf.class),
ml as (select class, n, x, y, p0 as p, 'poly model deg 0' as type, 1 as params from pd union all select class, n, x, y, p1, 'poly model deg 1', 2 from pd union all select class, n, x, y, p2, 'poly model deg 2', 3 from pd
       union all select class, n, x, y, pi, 'I-phase model', 1 from pd union all select class, n, x, y, pm, 'M-phase model', 1 from pd)"""

#: Statistics of the nested models and the tail of the F distribution: the continued fraction of the incomplete beta function, a term per level of recursion.
F_TESTS = MODELS + """, rs as (select class, type, n, params, sum((y - p) ** 2) as rss from ml group by all),
fs as (select l.type as model1, s.type as model2, l.class, case when l.params > s.params and l.n > l.params then ((s.rss - l.rss) / (l.params - s.params)) / (l.rss / (l.n - l.params)) end as f,
              (l.params - s.params)::double as dn, (l.n - l.params)::double as dd from rs l join rs s on l.class = s.class),
bx as (select *, case when flip then dn / 2 else dd / 2 end as a, case when flip then dd / 2 else dn / 2 end as b, case when flip then 1 - x0 else x0 end as x
       from (select *, dd / (dd + dn * f) as x0, dd / (dd + dn * f) >= (dd / 2 + 1) / (dd / 2 + dn / 2 + 2) as flip from fs where f > 0)),
cf0(model1, model2, class, m, c, d, v) as (select model1, model2, class, 0, 1::double, 1 / (1 - (a + b) * x / (a + 1)), 1 / (1 - (a + b) * x / (a + 1)) from bx
       union all
       select model1, model2, class, m, co, dq, v * c1 * d1 * co * dq from (
         select *, 1 + up / c1 as co, 1 / (1 + up * d1) as dq from (
           select *, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)) as up from (
             select *, 1 + u1 / c as c1, 1 / (1 + u1 * d) as d1 from (
               select r.model1, r.model2, r.class, r.m + 1 as m, r.c, r.d, r.v, a, b, x, (r.m + 1) * (b - (r.m + 1)) * x / ((a + 2 * (r.m + 1) - 1) * (a + 2 * (r.m + 1))) as u1
               from cf0 r join bx on r.model1 = bx.model1 and r.model2 = bx.model2 and r.class = bx.class where r.m < 200))))),
pv as (select bx.model1, bx.model2, bx.class, flip, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x)) * v / a as t
       from bx join cf0 on bx.model1 = cf0.model1 and bx.model2 = cf0.model2 and bx.class = cf0.class and m = 200)"""
