"""Every query of the engine's own operators on the shared tables, with the SQL each must equal.

The tables are generic, so columns are relabelled: a line item is a junction
row or a value interval, an order a sample, a nation a study, a quantity a
coverage.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import scalars
from tallyweave import folders
from tallyweave.operators import annotation, checks, ids, intervals, joins, junctions, matrix, metadata, qc, ranges, rejoin
from tallyweave.plans import unify
from tallyweave.sources import deltas, frames, indexed, readers, writers
from tallyweave.streaming import readiness

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _long(c: str) -> Column:
    return F.col(c).cast("long")


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """Line items as junction rows of many samples."""
    return _table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + 100).alias("end"),
        F.col("l_linenumber").cast("string").alias("name"), _long("l_quantity").alias("cov"), F.translate("l_linestatus", "OF", "+-").alias("strand"),
        F.when(F.col("l_suppkey") % 3 == 0, "GT-AG").when(F.col("l_suppkey") % 3 == 1, "gc-ag").otherwise("AT-AC").alias("motif"), F.col("l_orderkey").alias("sample"),
    )


_J = """j as (select l_returnflag chrom, l_partkey as start, l_partkey + 100 as "end", cast(l_linenumber as varchar) as name, cast(l_quantity as bigint) cov,
  translate(l_linestatus, 'OF', '+-') strand, case l_suppkey % 3 when 0 then 'GT-AG' when 1 then 'gc-ag' else 'AT-AC' end motif, l_orderkey sample from lineitem)"""
_TIE = "name, cast(cov as varchar), strand, motif, cast(sample as varchar)"
_MERGED = f"""select chrom, start, "end", first(strand order by {_TIE}) strand, first(motif order by {_TIE}) motif,
  string_agg(',' || sample || ':' || cov, '' order by {_TIE}) samples from j group by chrom, start, "end" """


@_query(f"with {_J} {_MERGED}")
def junction_merge(spark, d):
    return junctions.merge_packed(_rows(spark, d))


@_query(f"""with {_J} select j.*, f.strand as first_strand, f.motif as first_motif from (select chrom, start, "end", name, cov, sample from j) j
  join (select chrom, start, "end", first(strand order by {_TIE}) strand, first(motif order by {_TIE}) motif from j group by all) f using (chrom, start, "end")""")
def junction_merge_long(spark, d):
    return junctions.merge_long(_rows(spark, d)).withColumnsRenamed({"strand": "first_strand", "motif": "first_motif"})


_TWO = """select chrom, start, "end", first(strand order by strand, motif, samples) strand, first(motif order by strand, motif, samples) motif, string_agg(samples, '' order by strand, motif, samples) samples
from (select * from a union all select * from b) group by chrom, start, "end" """


@_query(f"with {_J}, a as ({_MERGED.replace('from j', 'from (select * from j where sample % 2 = 0)')}), b as ({_MERGED.replace('from j', 'from (select * from j where sample % 2 = 1)')}) {_TWO}")
def junction_merge_hier(spark, d):
    """Samples merged in two groups, then the groups."""
    rows = _rows(spark, d)
    return junctions.merge_again([junctions.merge_packed(rows.where(F.col("sample") % 2 == i)) for i in (0, 1)])


@_query(f"with {_J} select chrom, start, \"end\", cast(count(*) as bigint) as count, cast(sum(cov) as bigint) as sum, round(avg(cov), 3) as avg, round(quantile_cont(cov, 0.5), 3) as median from j group by chrom, start, \"end\"")
def junction_stats(spark, d):
    return junctions.sample_statistics(_rows(spark, d))


@_query(f"with {_J}, a as ({_MERGED.replace('from j', 'from (select * from j where sample % 10 < 8)')}), b as ({_MERGED.replace('from j', 'from (select * from j where sample % 10 >= 8)')}) {_TWO}")
def merge_with_existing(spark, d):
    """New samples merged into a database that is already there."""
    rows = _rows(spark, d)
    existing = junctions.merge_packed(rows.where(F.col("sample") % 10 < 8))
    return junctions.merge_again([junctions.merge_packed(rows.where(F.col("sample") % 10 >= 8)), existing])


@_query(f"""with {_J}, m as (select chrom, start + 7 as start, "end", name, cov, strand, motif, sample from j)
  select chrom, start, "end", first(strand order by {_TIE}) strand, first(motif order by {_TIE}) motif, string_agg(',' || sample || ':' || cov, '' order by {_TIE}) samples, first(name order by {_TIE}) as name from m group by chrom, start, "end" """)
def junction_merge_lifted(spark, d):
    return junctions.merge_lifted(_rows(spark, d), offset=7, extra="name")


@_query(f"""with {_J}, u as (select distinct chrom, start, "end", strand from j) select start, "end", min(case when chrom = 'A' then strand end) strand
  from u group by start, "end" having count(distinct chrom) = 3""")
def intersect_nway(spark, d):
    """Coordinates that all three sources have."""
    rows = _rows(spark, d).select("chrom", "start", "end", "strand").distinct()
    return junctions.intersect([rows.where(F.col("chrom") == c).drop("chrom") for c in "ANR"], key=("start", "end"))


@_query("""select l_orderkey as sample, l_partkey as start, cast(l_quantity as bigint) as uniques, cast(l_quantity as bigint) + l_linenumber as total, translate(cast(l_linenumber % 3 as varchar), '012', '?+-') strand, 'CC-CC' motif from lineitem""")
def aligner_reformat(spark, d):
    raw = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("sample"), F.col("l_partkey").alias("start"), (F.col("l_linenumber") % 3).alias("strand"), F.lit(1).alias("motif"), F.lit(0).alias("annotated"), _long("l_quantity").alias("num_uniques"), _long("l_linenumber").alias("num_multis"), F.lit(9).alias("max_overhang"))
    return junctions.reformat_aligner(raw)


@_query(f"with {_J} select * from j where regexp_matches(motif, '[AG]T-A[GC]') and motif <> 'GT-AC' and strand <> '?'")
def canonical_motifs(spark, d):
    return junctions.non_canonical(_rows(spark, d))


_ANN = """ann as (select substr(p_type, 1, 1) chrom, p_partkey as start, p_partkey + 100 as "end", p_brand sources from part
  union all select 'A', p_partkey, p_partkey + 100 + p_size % 2, p_brand || ',X' from part where p_size <= 10)"""


@_query(f"""with {_J}, {_ANN}, s as (select chrom, start, "end", unnest(string_split(sources, ',')) x from ann),
  l as (select chrom, start, string_agg(distinct x, ',' order by x) v from s group by chrom, start), r as (select chrom, "end", string_agg(distinct x, ',' order by x) v from s group by chrom, "end")
  select j.chrom, j.start, j."end", j.sample, j.motif, j."end" + 1 - j.start as length, case when exists (select 1 from ann where ann.chrom = j.chrom and ann.start = j.start and ann."end" = j."end") then 1 else 0 end annotated,
  upper(split_part(motif, '-', 1)) left_motif, upper(split_part(motif, '-', 2)) right_motif, coalesce(l.v, '0') left_annotated, coalesce(r.v, '0') right_annotated
  from j left join l on l.chrom = j.chrom and l.start = j.start left join r on r.chrom = j.chrom and r."end" = j."end" """)
def annotate_exact_left_right(spark, d):
    part = _table(spark, d, "part")
    size = F.col("p_partkey") + 100
    one = part.select(F.substring("p_type", 1, 1).alias("chrom"), F.col("p_partkey").alias("start"), size.alias("end"), F.col("p_brand").alias("sources"))
    two = part.where("p_size <= 10").select(F.lit("A").alias("chrom"), F.col("p_partkey").alias("start"), (size + F.col("p_size") % 2).alias("end"), F.concat("p_brand", F.lit(",X")).alias("sources"))
    return junctions.annotate(_rows(spark, d).select("chrom", "start", "end", "sample", "motif"), one.unionByName(two))


@_query("select p_name, p_partkey, row_number() over (order by p_name, p_partkey) - 1 as row_id from part")
def dense_ids(spark, d):
    return ranges.numbered(_table(spark, d, "part").select("p_name", "p_partkey"), ["p_name", "p_partkey"])


@_query("""with j as (select cast(doc_id as varchar) chrom, length(text) n, text, length(text) // 4 + 1 as start, length(text) // 2 + 3 as "end" from documents)
  select chrom, start, "end", case when "end" <= n and start + 1 <= n then substr(text, cast(start as bigint), 2) || '-' || substr(text, cast("end" - 1 as bigint), 2) end motif from j""")
def motif_lookup(spark, d):
    """Two characters at either end of a span, from texts cut into overlapping chunks; null where a span leaves the text."""
    docs = _table(spark, d, "documents").withColumn("n_chars", F.length("text").cast("long"))
    spans = docs.select(F.col("doc_id").cast("string").alias("chrom"), F.expr("n_chars div 4 + 1").alias("start"), F.expr("n_chars div 2 + 3").alias("end"))
    chunks = junctions.genome_chunks(docs.select(F.col("doc_id").cast("string").alias("chrom"), F.col("text").alias("seq")), 1000)
    return junctions.look_up_motifs(spans, chunks, 1000).select("chrom", "start", "end", "motif")


@_query("""with m as (select l_returnflag chrom, l_partkey + 10 + 1 as start, l_partkey + 100 - 20 as "end", cast(l_quantity as bigint) score, l_linestatus strand from lineitem)
  select chrom, start, "end", cast(sum(score) as bigint) score, max(strand) strand, 'GT-AG' motif from m group by chrom, start, "end" """)
def regtools_consolidate(spark, d):
    rows = _table(spark, d, "lineitem").select(F.col("l_returnflag").alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + 100).alias("end"), _long("l_quantity").alias("score"), F.col("l_linestatus").alias("strand"), F.lit("10,20").alias("block_sizes"))
    return junctions.consolidate_bed12(rows)


@_query("""with e as (select p_partkey, p_brand f from part union all select p_partkey, p_type from part)
  select f as feature, l_linenumber as sample, cast(sum(cast(l_quantity as bigint)) as bigint) cov from lineitem join e on l_partkey = p_partkey group by f, l_linenumber""")
def rejoin_sum(spark, d):
    part = _table(spark, d, "part")
    edges = part.select("p_partkey", F.col("p_brand").alias("feature")).unionByName(part.select("p_partkey", F.col("p_type").alias("feature")))
    counts = _table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_linenumber").alias("sample"), _long("l_quantity").alias("cov"))
    return rejoin.rejoin(counts, edges, ["p_partkey"], ["feature"])


@_query("""with n as (select p_brand feature, p_type as name, sum(p_size) l from (select distinct p_brand, p_type, p_partkey, p_size from part) group by p_brand, p_type)
  select feature, cast(max(l) as bigint) bp_length, string_agg(name, ';' order by name) as names from n group by feature""")
def feature_lengths(spark, d):
    part = _table(spark, d, "part").select(F.col("p_brand").alias("feature"), F.col("p_type").alias("name"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size")).alias("end"))
    return rejoin.feature_lengths(part, ["feature"], "name")


@_query("select * exclude (n) from (select *, row_number() over (partition by l_orderkey, l_suppkey order by l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate) n from lineitem) where n = 1")
def dedupe_first(spark, d):
    return junctions.first_of(_table(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"], ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"])


@_query("select l_orderkey, l_suppkey, l_linenumber from (select *, row_number() over (partition by l_orderkey, l_suppkey order by l_linenumber) n from lineitem) where n > 1")
def dedupe_report(spark, d):
    return junctions.repeats_of(_table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber"), ["l_orderkey", "l_suppkey"], ["l_linenumber"])


@_query("select l_returnflag, l_linestatus, cast(sum(cast(l_quantity as bigint)) as bigint) as value from lineitem group by all")
def matrix_axis0(spark, d):
    return matrix.reduce_axis(_table(spark, d, "lineitem").withColumn("value", _long("l_quantity")), ["l_returnflag", "l_linestatus"])


@_query("select l_orderkey, avg(cast(l_quantity as bigint)) as value from lineitem group by l_orderkey")
def matrix_axis1(spark, d):
    return matrix.reduce_axis(_table(spark, d, "lineitem").withColumn("value", _long("l_quantity")), ["l_orderkey"], how="avg")


@_query("""with l as (select l_orderkey, l_suppkey, cast(sum(cast(l_quantity as bigint)) as bigint) cov from lineitem group by all)
  select dense_rank() over (order by l_orderkey) row_idx, dense_rank() over (order by l_suppkey) col_idx, cov from l""")
def sparse_coo(spark, d):
    long = _table(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sum(_long("l_quantity")).alias("cov"))
    return matrix.sparse(long, ["l_orderkey"], "l_suppkey", "cov")[0]


@_query("""with l as (select l_orderkey, l_suppkey from lineitem group by all) select (select count(*) from l) entries, (select count(distinct l_orderkey) from l) as rows, (select count(distinct l_suppkey) from l) as columns, true ok""")
def matrix_check(spark, d):
    long = _table(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sum(_long("l_quantity")).alias("cov"))
    return checks.sparse_matrix(*matrix.sparse(long, ["l_orderkey"], "l_suppkey", "cov"))


@_query(f"with {_J} select chrom, start, \"end\", sample, cov from j")
def packed_round_trip(spark, d):
    """Packed lists taken apart again give back every sample and coverage."""
    return matrix.packed_to_long(junctions.merge_packed(_rows(spark, d)), kind="long").select("chrom", "start", "end", "sample", "cov")


@_query("""with w as (select l_suppkey, l_returnflag, cast(sum(cast(l_quantity as bigint)) as bigint) v from lineitem group by all),
  p as (select l_suppkey, coalesce(max(case when l_returnflag = 'A' then v end), 0) a, coalesce(max(case when l_returnflag = 'N' then v end), 0) n, coalesce(max(case when l_returnflag = 'R' then v end), 0) r from w group by l_suppkey)
  select l_suppkey, (case when a > 0 then ',A:' || a else '' end) || (case when n > 0 then ',N:' || n else '' end) || (case when r > 0 then ',R:' || r else '' end) samples from p""")
def wide_to_packed(spark, d):
    long = _table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", _long("l_quantity").alias("v"))
    return matrix.wide_to_packed(matrix.long_to_wide(long, ["l_suppkey"], "l_returnflag", "v", ["A", "N", "R"]), ["l_suppkey"], ["A", "N", "R"])


@_query("""select l_partkey, string_agg(samples, '' order by l_returnflag) samples from (select l_partkey, l_returnflag, string_agg(',' || l_orderkey || ':' || cast(l_quantity as bigint), '' order by l_orderkey, l_linenumber, l_quantity) samples from lineitem group by all) group by l_partkey""")
def concatenate_studies(spark, d):
    entries = F.sort_array(F.collect_list(F.struct("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("sample"), _long("l_quantity").alias("cov"))))
    parts = _table(spark, d, "lineitem").groupBy("l_partkey", "l_returnflag").agg(scalars.pack_samples(entries).alias("samples"))
    return matrix.concatenated(parts, ["l_partkey"], "l_returnflag")


@_query("select p_partkey, unnest(range(1, p_size + 1)) as copy from part where p_size > 0")
def row_replication(spark, d):
    return rejoin.replicate(_table(spark, d, "part").select("p_partkey", "p_size"), "p_size").select("p_partkey", _long("copy").alias("copy"))


@_query("""select coalesce(c_custkey, o_custkey) as key, coalesce(c_name, '') c_name, coalesce(cast(o_orderkey as varchar), '') o_orderkey from customer full join (select o_custkey + 100 o_custkey, o_orderkey from orders) on c_custkey = o_custkey""")
def outer_join_pad(spark, d):
    small = _table(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    large = _table(spark, d, "orders").select((F.col("o_custkey") + 100).alias("key"), "o_orderkey")
    return joins.padded_join(small, large, "key")


@_query("select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')")
def semi_filter(spark, d):
    words = _table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return joins.filter_by(_table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", words, "o_custkey")


@_query("select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')")
def anti_filter(spark, d):
    words = _table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return joins.filter_by(_table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", words, "o_custkey", exclude=True)


@_query("select c_custkey, c_name from customer join orders on o_custkey = c_custkey")
def redundant_filter(spark, d):
    return joins.filter_by(_table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", _table(spark, d, "orders"), "o_custkey", repeat=True)


@_query("select p_partkey, p_name from part where list_has_any(string_split(lower(p_name), ' '), (select list(distinct lower(split_part(p_name, ' ', 2))) from part where p_brand = 'Brand#1' and p_size <= 5))")
def word_filter(spark, d):
    """Parts whose name holds a word that the second word of a small part's name is, in either case."""
    words = _table(spark, d, "part").where("p_brand = 'Brand#1' and p_size <= 5").select(F.upper(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("w"))
    return joins.filter_by(_table(spark, d, "part").select("p_partkey", "p_name"), "p_name", words, "w", delimiter=" ", ignore_case=True)


@_query("select c_custkey, c_mktsegment from customer where exists (select 1 from supplier where regexp_matches(c_name, '0' || s_suppkey || '$'))")
def pattern_filter(spark, d):
    """Customers whose name ends in a supplier's number."""
    patterns = _table(spark, d, "supplier").select(F.concat(F.lit("0"), F.col("s_suppkey").cast("string"), F.lit("$")).alias("p"))
    return joins.filter_by_patterns(_table(spark, d, "customer"), "c_name", patterns, "p").select("c_custkey", "c_mktsegment")


@_query("""select p_partkey, coalesce(a.s_name, b.s_name) s_name from part left join supplier a on a.s_suppkey = p_size * 100 left join supplier b on b.s_suppkey = p_size""")
def fallback_lookup(spark, d):
    """A second key is tried where the first finds nothing."""
    rows = _table(spark, d, "part").select("p_partkey", (F.col("p_size") * 100).cast("long").alias("k1"), _long("p_size").alias("k2"))
    return joins.first_match(rows, _table(spark, d, "supplier"), ["k1", "k2"], "s_suppkey", "s_name").select("p_partkey", "s_name")


@_query("""select s_suppkey, cast(coalesce(n, s_nationkey) as integer) s_nationkey, coalesce(n is not null and n <> s_nationkey, false) changed from supplier left join (select s_suppkey k, (s_nationkey + s_suppkey % 2) % 25 n from supplier where s_acctbal < 4000) on k = s_suppkey""")
def upsert_counts(spark, d):
    old = _table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    new = _table(spark, d, "supplier").where("s_acctbal < 4000").select(old.columns).withColumn("s_nationkey", ((F.col("s_nationkey") + F.col("s_suppkey") % 2) % 25).cast("int"))
    return rejoin.updated(old, new, ["s_suppkey"], ["s_nationkey"])


@_query("select p_partkey, p_name, o.position from part join (select p_partkey, row_number() over (order by p_name, p_partkey) as position from part) o using (p_partkey)")
def gene_order(spark, d):
    part = _table(spark, d, "part")
    order = ranges.numbered(part.select("p_partkey", "p_name"), ["p_name", "p_partkey"], "position", 1)
    return rejoin.in_order(part.select("p_partkey", "p_name"), order, "p_partkey", "position")[0]


@_query("""with iv as (select l_returnflag chrom, l_orderkey id, l_partkey * 1000 + l_orderkey % 1000 as start, l_partkey * 1000 + l_orderkey % 1000 + cast(l_quantity as bigint) as "end" from lineitem)
  select a.chrom, a.id, a.start, a."end", b.id id_r, b.start start_r, b."end" end_r from iv a join iv b on a.chrom = b.chrom and a.start < b."end" and b.start < a."end" """)
def interval_overlap(spark, d):
    start = F.col("l_partkey") * 1000 + F.col("l_orderkey") % 1000
    iv = _table(spark, d, "lineitem").select(F.col("l_returnflag").alias("chrom"), F.col("l_orderkey").alias("id"), start.alias("start"), (start + _long("l_quantity")).alias("end"))
    return intervals.overlap_join(iv, iv, 64)


@_query("""with r as (select p_partkey * 10 as start, p_partkey * 10 + 40 as "end" from part), v as (select distinct l_partkey * 10 + 20 as start, l_partkey * 10 + 25 as "end", l_partkey % 7 as value from lineitem)
  select r.start, r."end", coalesce(sum(v.value * (least(r."end", v."end") - greatest(r.start, v.start))), 0) / (r."end" - r.start) as value from r left join v on r.start < v."end" and v.start < r."end" group by r.start, r."end" """)
def region_means(spark, d):
    regions = _table(spark, d, "part").select((F.col("p_partkey") * 10).alias("start"), (F.col("p_partkey") * 10 + 40).alias("end"))
    values = _table(spark, d, "lineitem").select((F.col("l_partkey") * 10 + 20).alias("start"), (F.col("l_partkey") * 10 + 25).alias("end"), (F.col("l_partkey") % 7).alias("value")).distinct()
    return intervals.summarise_regions(regions, values, on=())


@_query("""with iv as (select l_suppkey chrom, l_partkey * 3 as start, l_partkey * 3 + cast(l_quantity as bigint) as "end" from lineitem),
  f as (select *, max("end") over (partition by chrom order by start, "end" rows between unbounded preceding and 1 preceding) p from iv),
  i as (select *, sum(case when p is null or start - p >= 2 then 1 else 0 end) over (partition by chrom order by start, "end" rows unbounded preceding) g from f)
  select chrom, min(start) as start, max("end") as "end" from i group by chrom, g""")
def interval_coalesce(spark, d):
    iv = _table(spark, d, "lineitem").select(F.col("l_suppkey").alias("chrom"), (F.col("l_partkey") * 3).alias("start"), (F.col("l_partkey") * 3 + _long("l_quantity")).alias("end"))
    return intervals.coalesce(iv)


@_query("""with iv as (select l_suppkey chrom, l_partkey * 3 as start, l_partkey * 3 + cast(l_quantity as bigint) as "end" from lineitem),
  b as (select chrom, start p from iv union select chrom, "end" + 1 from iv), s as (select chrom, p as start, lead(p) over (partition by chrom order by p) - 1 as "end" from b)
  select chrom, start, "end" from s where "end" is not null and exists (select 1 from iv where iv.chrom = s.chrom and iv.start <= s.start and iv."end" >= s."end")""")
def disjoin(spark, d):
    iv = _table(spark, d, "lineitem").select(F.col("l_suppkey").alias("chrom"), (F.col("l_partkey") * 3).alias("start"), (F.col("l_partkey") * 3 + _long("l_quantity")).alias("end"))
    return intervals.disjoin(iv, ["chrom"])


@_query("""with p as (select distinct o_custkey as g, o_orderkey % 1000 p from orders), i as (select g, p, p - row_number() over (partition by g order by p) k from p)
  select g, min(p) as first, max(p) as last, case when min(p) = max(p) then cast(min(p) as varchar) else min(p) || '-' || max(p) end as range from i group by g, k""")
def gaps_islands(spark, d):
    return intervals.islands(_table(spark, d, "orders").select(F.col("o_custkey").alias("g"), (F.col("o_orderkey") % 1000).alias("p")), "p", ["g"])


@_query("""with p as (select distinct o_custkey as g, o_orderkey p from orders), l as (select g, lag(p) over (partition by g order by p) + 1 a, p - 1 b from p) select g, a as first, b as last from l where a <= b""")
def gap_complement(spark, d):
    return intervals.gaps(_table(spark, d, "orders").select(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("p")), "p", ["g"])


def _bits(n: str, width: int) -> str:
    return "(" + " || ".join(f"cast(({n} >> {i}) % 2 as varchar)" for i in reversed(range(width))) + ")"


_DIGIT = "cast(substr(lpad(cast(c_custkey as varchar), 6, '0'), {}, 1) as integer)"


@_query(f"""with a as (select 'SRR' || lpad(cast(c_custkey as varchar), 6, '0') accession, c_custkey, {' || '.join(_bits(_DIGIT.format(i), 4) for i in (4, 5, 6))} prefix,
   {_DIGIT.format(4)} * 256 + {_DIGIT.format(5)} * 16 + {_DIGIT.format(6)} p from customer),
  n as (select *, row_number() over (partition by prefix order by c_custkey) - 1 as counter from a)
  select accession, c_custkey, prefix, counter, case when counter < 2 then (4096 + p) * 2 + counter else (4096 + p) * (1 << cast(floor(log2(counter)) + 1 as integer)) + counter end rail_id from n""")
def rail_ids(spark, d):
    samples = _table(spark, d, "customer").select(F.concat(F.lit("SRR"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("accession"), "c_custkey")
    return ids.assign(samples, 1, "c_custkey")


@_query("select user_id, event_type, min(event_id) event_id from events group by user_id, event_type")
def attempt_pick(spark, d):
    return junctions.first_of(_table(spark, d, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["event_id"])


@_query("""select cast(substr(p, 1, 1) as varchar) as study, a as attempt, p as path from (select 'S' || user_id || '!T' || user_id % 7 || '!hg_att' || (event_id % 4) p, event_id % 4 a, user_id u, row_number() over (partition by user_id order by event_id % 4, event_id) n from events) where n = 1""".replace("cast(substr(p, 1, 1) as varchar)", "'T' || u % 7"))
def finished_attempts(spark, d):
    """The lowest attempt of each job, from its files' names."""
    path = F.concat(F.lit("S"), F.col("user_id").cast("string"), F.lit("!T"), (F.col("user_id") % 7).cast("string"), F.lit("!hg_att"), (F.col("event_id") % 4).cast("string"))
    files = _table(spark, d, "events").select(path.alias("path"), "user_id")
    first = readers.lowest_attempt(files, ["user_id"])
    return first.select(scalars.file_parts(F.col("path"))[1].alias("study"), F.col("attempt").cast("long").alias("attempt"), "path")


@_query("""with done as (select o_custkey as study, count(*) n from orders where o_orderstatus <> 'P' group by 1), want as (select o_custkey as study, count(*) n from orders group by 1)
  select study, n from done join want using (study, n)""")
def readiness_batch(spark, d):
    orders = _table(spark, d, "orders").withColumn("study", F.col("o_custkey"))
    return joins.ready(orders.where("o_orderstatus <> 'P'"), orders, "study")


@_query("""select event_type as study, count(distinct user_id) as n from events group by event_type""")
def readiness_stream(spark, d):
    """Markers read as a stream until none is left; a study's last count is its distinct users."""
    stream = spark.readStream.schema(_table(spark, d, "events").schema).parquet(f"{d}/events.parquet*").select(F.col("event_type").alias("study"), F.col("user_id").cast("string").alias("sample"))
    return readiness.counts_of(stream, f"{folders.shared_folder(spark)}/ready-{uuid4().hex}")


@_query("""select c_custkey as sample, coalesce(n, 0) junction_count, coalesce(s, 0) coverage, case when n > 0 then round(s / n, 3) else 0.0 end as avg from customer left join (select o_custkey + 100 k, count(*) n, cast(sum(cast(o_totalprice as bigint)) as bigint) s from orders group by o_custkey) on k = c_custkey""")
def sample_totals_zero_fill(spark, d):
    rows = _table(spark, d, "orders").select((F.col("o_custkey") + 100).alias("sample"), F.round("o_totalprice").cast("long").alias("cov"))
    return junctions.sample_totals(_table(spark, d, "customer").select(F.col("c_custkey").alias("sample")), rows)


_SQL["sample_totals_zero_fill"] = _SQL["sample_totals_zero_fill"].replace("cast(o_totalprice as bigint)", "cast(round(o_totalprice) as bigint)")


@_query("""select gene_id, lang, cast(sum(n_chars) as bigint) cov from (select unnest(string_split(source || ',' || lang || ',g' || doc_id % 50, ',')) gene_id, lang, n_chars from documents) group by gene_id, lang""")
def multi_gene_explode(spark, d):
    exons = _table(spark, d, "documents").select(F.concat_ws(",", "source", "lang", F.concat(F.lit("g"), (F.col("doc_id") % 50).cast("string"))).alias("gene_ids"), F.col("n_chars").alias("cov"), "lang")
    return rejoin.sums_of_listed_genes(exons, sample=("lang",))


@_query("""select l_partkey as chrom, l_suppkey as start, l_suppkey + 5 as "end", l_linestatus strand, string_agg(distinct l_returnflag, ',' order by l_returnflag) sources from lineitem group by all""")
def source_union(spark, d):
    rows = _table(spark, d, "lineitem").select(F.col("l_partkey").alias("chrom"), F.col("l_suppkey").alias("start"), (F.col("l_suppkey") + 5).alias("end"), F.col("l_linestatus").alias("strand"), F.col("l_returnflag").alias("source"))
    return annotation.unite_sources(rows)


@_query("""select p_brand as transcript, 'c' chrom, '+' strand, a + 1 as start, p_partkey * 3 - 1 as "end" from (select p_brand, p_partkey, lag(p_partkey * 3 + p_size % 2) over (partition by p_brand order by p_partkey) a from part) where a is not null and p_partkey * 3 - 1 >= a + 1""")
def exon_introns(spark, d):
    exons = _table(spark, d, "part").select(F.col("p_brand").alias("transcript"), F.lit("c").alias("chrom"), F.lit("+").alias("strand"), (F.col("p_partkey") * 3).alias("start"), (F.col("p_partkey") * 3 + F.col("p_size") % 2).alias("end"))
    return rejoin.previous_exon_introns(exons)


@_query("""select user_id, coalesce(c, 0) click, coalesce(p, 0) purchase, case when c + 0 > 0 and p is not null then round(100.0 * p / c, 2) else -1.0 end as purchase_percent from
  (select user_id, nullif(count(*) filter (where event_type = 'click'), 0) c, nullif(count(*) filter (where event_type = 'purchase'), 0) p from events group by user_id)""")
def qc_ratio_pivot(spark, d):
    long = _table(spark, d, "events").groupBy("user_id", F.col("event_type").alias("key")).agg(F.count("*").alias("value"))
    wide = qc.table(long, ["user_id"], ["click", "purchase"])
    return wide.select("user_id", F.coalesce("click", F.lit(0)).alias("click"), F.coalesce("purchase", F.lit(0)).alias("purchase"), qc.percent(F.col("purchase"), F.col("click")).alias("purchase_percent"))


@_query("""select event_id, 'k' as key, regexp_extract(props, '"k": (\\d+)', 1) as value from events where regexp_matches(props, '"k": \\d+')""")
def log_metrics(spark, d):
    return qc.metrics(_table(spark, d, "events").select("event_id", F.col("props").alias("text")), {"k": r'"k": (\d+)'})


@_query("""with e as (select event_type as rule, cast(json_extract_string(props, '$.k') as double) s from events), g as (select rule, sum(s) total, min(s) least, max(s) most from e group by rule) select *, round(100.0 * total / (select sum(total) from g), 2) as percent from g""")
def json_stats(spark, d):
    """Run statistics in JSON, one file's text for each event, read back and shared out by rule."""
    path = f"{folders.shared_folder(spark)}/stats-{uuid4().hex}"
    rules = F.map_from_arrays(F.array("event_type"), F.array(F.struct(F.get_json_object("props", "$.k").cast("double").alias("min-runtime"))))
    _table(spark, d, "events").select(F.to_json(F.struct(F.lit(1.0).alias("total_runtime"), rules.alias("rules"))).alias("value")).write.text(path)
    return qc.run_times(readers.run_statistics(spark, path, lines=True))


@_query("""with e as (select event_type as rule, cast(user_id as double) s from events), g as (select rule, sum(s) total, min(s) least, max(s) most from e group by rule) select *, round(100.0 * total / (select sum(total) from g), 2) as percent from g""")
def run_time_shares(spark, d):
    return qc.run_times(_table(spark, d, "events").select(F.col("event_type").alias("rule"), F.col("user_id").cast("double").alias("seconds")))


@_query("""with v as (select cast(l_quantity as bigint) q, count(*) n from lineitem group by 1) select cast(sum(q * n) // sum(n) as bigint) as avg, first(q order by n desc, q) as mode, max(n) mode_count, cast(sum(q * n) as bigint) as total from v""")
def integer_stream_stats(spark, d):
    return matrix.whole_number_stats(_table(spark, d, "lineitem").select(_long("l_quantity").alias("q")), "q")


@_query("""select doc_id as line, 1 as field from documents where coalesce(lang, '') = '' union all select doc_id, 2 from documents where regexp_replace(source, 'src1.*', '') = ''""")
def blank_check(spark, d):
    docs = _table(spark, d, "documents").select(F.col("doc_id").alias("line"), "lang", F.regexp_replace("source", "src1.*", "").alias("s"))
    return checks.blanks(docs, "line", ["lang", "s"])


@_query("""select * from (select l_orderkey, count(*) as found, max(l_linenumber) as expected from lineitem group by l_orderkey) where found <> expected""")
def count_check(spark, d):
    rows = _table(spark, d, "lineitem")
    return checks.counts_against(rows, rows.groupBy("l_orderkey").agg(_max_long("l_linenumber").alias("expected")), ["l_orderkey"]).withColumn("expected", F.col("expected").cast("int"))


def _max_long(c: str) -> Column:
    return F.max(F.col(c).cast("long"))


@_query("""select k, a as left, b as right from (select l_suppkey k, cast(sum(cast(l_quantity as bigint)) as bigint) a from lineitem where l_linenumber <> 7 group by 1) full join (select l_suppkey k, cast(sum(cast(l_quantity as bigint)) as bigint) b from lineitem group by 1) using (k) where a is distinct from b""".replace("a as left, b as right", 'a as "left", b as "right"'))
def resum_check(spark, d):
    rows = _table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), _long("l_quantity").alias("v"), "l_linenumber")
    return checks.equal_sums(rows.where("l_linenumber <> 7"), rows, "k", "v")


@_query("""(select p_partkey, p_size, 'old' side from part except all select p_partkey, p_size + case when p_partkey % 11 = 0 then 1 else 0 end, 'old' from part)
  union all (select p_partkey, p_size + case when p_partkey % 11 = 0 then 1 else 0 end, 'new' from part except all select p_partkey, p_size, 'new' from part)""")
def matrix_diff(spark, d):
    old = _table(spark, d, "part").select("p_partkey", "p_size")
    return checks.difference(old, old.withColumn("p_size", F.when(F.col("p_partkey") % 11 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))))


@_query("select l_orderkey, count(*) files from lineitem group by l_orderkey having count(*) <> 4")
def completeness(spark, d):
    return checks.incomplete(_table(spark, d, "lineitem"), "l_orderkey", 4)


@_query("""select p_partkey, replace(replace(p_name, 'x', ''), '', '') as name, gene, annotation from (select p_partkey, 'G' || p_partkey || case when p_size % 3 = 0 then '.A1' when p_size % 3 = 1 then '.B2.5' else '' end p_name, 'G' || p_partkey || case when p_size % 3 = 1 then '.5' else '' end gene, case p_size % 3 when 0 then 'A1' when 1 then 'B2' end annotation from part)""")
def gene_names(spark, d):
    name = F.concat(F.lit("G"), F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 3 == 0, ".A1").when(F.col("p_size") % 3 == 1, ".B2.5").otherwise(""))
    gene, known = scalars.gene_and_annotation(F.col("name"), ["A1", "B2"])
    return _table(spark, d, "part").select("p_partkey", name.alias("name")).select("p_partkey", "name", gene.alias("gene"), known.alias("annotation"))


@_query("""select exon, cast(a as integer) "A1", cast(b as integer) "B2", lpad(cast(a as varchar), 3, '0') || lpad(cast(b as varchar), 3, '0') mask from (select l_partkey exon, count(*) filter (where l_suppkey % 2 = 0) a, count(*) filter (where l_suppkey % 2 = 1) b from lineitem group by l_partkey)""")
def exon_masks(spark, d):
    rows = _table(spark, d, "lineitem").select(F.col("l_partkey").alias("exon"), F.concat(F.lit("G"), F.col("l_suppkey").cast("string"), F.when(F.col("l_suppkey") % 2 == 0, ".A1").otherwise(".B2")).alias("gene"))
    return rejoin.exon_masks(rows.select("exon").distinct(), rows, ["A1", "B2"])


@_query("""with g as (select p_brand gene_id, string_agg(distinct s, ';') makeup, count(*) n from (select distinct p_brand, p_partkey, p_size from part) join (select 1) on true, lateral (select p_partkey || '-' || p_partkey + p_size s) group by 1) select gene_id, n exons from g""")
def exon_makeup(spark, d):
    exons = _table(spark, d, "part").select(F.col("p_brand").alias("gene_id"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size")).alias("end"))
    return rejoin.exon_makeup(exons).select("gene_id", "makeup", _long("exons").alias("exons"))


_SQL["exon_makeup"] = """with e as (select distinct p_brand gene_id, p_partkey s, p_partkey + p_size e from part)
  select gene_id, string_agg(s || '-' || e, ';' order by s, e) makeup, count(*) exons from e group by gene_id"""


@_query("""select o_orderstatus as study, count(*) n from orders group by o_orderstatus""")
def samples_per_study(spark, d):
    return metadata.samples_per_study(_table(spark, d, "orders").withColumnRenamed("o_orderstatus", "study"))


@_query("""select l_partkey as name, l_orderkey as sample, l_linenumber line from lineitem where l_returnflag = 'R'""")
def source_filter(spark, d):
    rows = _table(spark, d, "lineitem").select(F.col("l_partkey").alias("name"), F.col("l_orderkey").alias("sample"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("annotation"))
    return metadata.of_source(rows, "R").drop("annotation")


@_query("""select c_custkey * 3 as rail_id, c_nationkey as study, c_custkey as sample, c_mktsegment from customer""")
def metadata_rail_ids(spark, d):
    """Every sample must have an id; one without is an error."""
    customer = _table(spark, d, "customer").select(F.col("c_nationkey").alias("study"), F.col("c_custkey").alias("sample"), "c_mktsegment")
    return metadata.with_rail_ids(customer, customer.select("study", "sample", (F.col("sample") * 3).alias("rail_id")))


@_query("""select c_custkey * 3 as rail_id, cast(c_custkey as varchar) external_id, n_name as study, 'data_sources/x' as project, 'human' as organism, 'sra' file_source, 'sra' metadata_source, '2020-01-01' date_processed from customer join nation on c_nationkey = n_nationkey""")
def metadata_project(spark, d):
    samples = _table(spark, d, "customer").join(_table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select((F.col("c_custkey") * 3).alias("rail_id"), F.col("c_custkey").cast("string").alias("sample"), F.col("n_name").alias("study"))
    none = samples.select("sample", "study")
    return metadata.per_study(samples, none, none, "human", "sra", "sra", "2020-01-01", F.lit("data_sources/x"))["project"]


@_query("select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem")
def column_cut(spark, d):
    return metadata.cut(_table(spark, d, "lineitem"), [(1, 2), (4, 5)])


_LONG = """g as (select cast(l_linenumber as varchar) study, l_suppkey sample, l_partkey % 40 gene, cast(sum(cast(l_quantity as bigint)) as bigint) v from lineitem group by all)"""


@_query(f"""with {_LONG}, s as (select distinct study, sample from g), f as (select distinct gene, 'A' || gene % 2 annotation from g)
  select right(s.study, 2) study_lo, s.study, f.annotation, f.gene, s.sample, coalesce(g.v, 0) as value from s cross join f left join g on g.study = s.study and g.sample = s.sample and g.gene = f.gene""")
def study_split(spark, d):
    """Sums of every study, written as text by study and annotation, read back, and taken apart into cells."""
    long, features, samples = _gene_sums(spark, d)
    rows = unify.study_rows(long, features, samples, ["gene"])
    path = f"{folders.shared_folder(spark)}/studies-{uuid4().hex}"
    unify.write_studies(rows, path, ["gene"])
    return readers.study_cells(spark, path, ["gene"]).select("study_lo", "study", "annotation", _long("gene").alias("gene"), F.split_part("sample", F.lit("/"), F.lit(2)).cast("long").alias("sample"), _long("value").alias("value"))


def _gene_sums(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Long sums of forty genes, the genes with their annotation, and the samples of each study."""
    rows = _table(spark, d, "lineitem").select(F.col("l_linenumber").cast("string").alias("study"), F.col("l_suppkey").alias("own"), (F.col("l_partkey") % 40).alias("gene"), _long("l_quantity").alias("v"))
    rows = rows.withColumn("sample", F.concat_ws("/", "study", F.col("own").cast("string")))
    long = rows.groupBy("sample", "gene").agg(F.sum("v").alias("sum"))
    return long, long.select("gene", F.concat(F.lit("A"), (F.col("gene") % 2).cast("string")).alias("annotation")).distinct(), rows.select("study", "sample").distinct()


@_query("""with r as (select p_partkey, p_brand, (case when p_size > 25 then p_size + 1 else p_size end) <> p_size changed from part) select p_brand, count(distinct p_partkey) genes, string_agg(cast(p_partkey as varchar), ',' order by p_partkey) changed_genes from r where changed group by p_brand""")
def update_report(spark, d):
    old = _table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    new = _table(spark, d, "part").where("p_size > 25").select(old.columns).withColumn("p_size", F.col("p_size") + 1)
    report = metadata.update_report(rejoin.updated(old, new, ["p_partkey"], ["p_size"]), "p_partkey", ["p_brand"])
    return report.withColumn("changed_genes", F.array_join(F.transform("changed_genes", lambda x: x.cast("string")), ","))


@_query("""with r as (select p_partkey * 10 as start, p_partkey * 10 + 40 as "end" from part), v as (select distinct l_partkey * 10 + 20 as start, l_partkey * 10 + 25 as "end", l_partkey % 7 as value from lineitem)
  select r.start, r."end", cast(coalesce(sum(v.value * (least(r."end", v."end") - greatest(r.start, v.start))), 0) as bigint) as value from r left join v on r.start < v."end" and v.start < r."end" group by r.start, r."end" """)
def region_sums(spark, d):
    regions = _table(spark, d, "part").select((F.col("p_partkey") * 10).alias("start"), (F.col("p_partkey") * 10 + 40).alias("end"))
    values = _table(spark, d, "lineitem").select((F.col("l_partkey") * 10 + 20).alias("start"), (F.col("l_partkey") * 10 + 25).alias("end"), (F.col("l_partkey") % 7).alias("value")).distinct()
    return intervals.summarise_regions(regions, values, "sum", on=())


@_query("""with v as (select l_suppkey % 5 chrom, l_partkey * 4 as start, l_partkey * 4 + cast(l_quantity as bigint) as "end", l_orderkey as value, row_number() over (order by l_orderkey, l_linenumber) line from lineitem),
  p as (select chrom, unnest(range(start, "end")) b, value, line from v), w as (select chrom, b, arg_max(value, line) value from p group by chrom, b) select chrom, b as base, value from w""")
def last_writer_wins(spark, d):
    """Overlapping values as disjoint ones, base by base: of several lines the last counts."""
    lines = _table(spark, d, "lineitem").select((F.col("l_suppkey") % 5).alias("chrom"), (F.col("l_partkey") * 4).alias("start"), (F.col("l_partkey") * 4 + _long("l_quantity")).alias("end"), F.col("l_orderkey").alias("value"), "l_orderkey", "l_linenumber")
    lines = ranges.numbered(lines, ["l_orderkey", "l_linenumber"], "line").drop("l_orderkey", "l_linenumber")
    flat = intervals.last_writer(lines)
    return flat.select("chrom", F.explode(F.sequence("start", F.col("end") - 1)).alias("base"), "value")


@_query("""with r as (select distinct l_returnflag chrom, l_linestatus strand, l_partkey * 3 as start, l_partkey * 3 + 20 as "end" from lineitem), m as (select distinct l_returnflag chrom, l_linestatus strand, l_suppkey * 5 as pos from lineitem)
  select r.chrom, r.start, r."end", r.strand, count(m.pos) as value from r left join m on r.chrom = m.chrom and r.strand = m.strand and m.pos >= r.start and m.pos < r."end" - 1 group by all""")
def region_marks(spark, d):
    """Marked bases of the same strand in each region, its last base aside."""
    rows = _table(spark, d, "lineitem").select(F.col("l_returnflag").alias("chrom"), F.col("l_linestatus").alias("strand"), "l_partkey", "l_suppkey")
    regions = rows.select("chrom", (F.col("l_partkey") * 3).alias("start"), (F.col("l_partkey") * 3 + 20).alias("end"), "strand").distinct()
    return intervals.mark_counts(regions, rows.select("chrom", "strand", (F.col("l_suppkey") * 5).alias("pos")))


@_query("""with s as (select o_custkey, count(*) n, cast(sum(o_orderkey) as bigint) k from orders group by 1) select c_custkey as sample, c_nationkey as study, c_name, n, k from customer join s on o_custkey = c_custkey""")
def qc_junction_statistics(spark, d):
    """Quality rows with their sample's statistics; those without any are left out first, as a miss is an error."""
    orders = _table(spark, d, "orders")
    qc_rows = _table(spark, d, "customer").select(F.col("c_custkey").alias("sample"), F.col("c_nationkey").alias("study"), "c_name")
    stats = orders.groupBy(F.col("o_custkey").alias("sample")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("k")).join(qc_rows.select("sample", "study"), "sample")
    return metadata.with_junction_statistics(joins.filter_by(qc_rows, "sample", stats, "sample"), stats).select("sample", "study", "c_name", "n", "k")


_CHAIN = """c as (select 'c' chrom, p_partkey * 50 as start, p_partkey * 50 + 40 as "end", 'd' || p_size % 3 to_chrom, p_size as shift from part)"""
_SPANS = """j as (select 'c' chrom, l_partkey * 50 + l_linenumber * 3 as start, l_partkey * 50 + l_linenumber * 3 + cast(l_quantity as bigint) % 30 as "end", l_orderkey id, l_linenumber line from lineitem)"""


def _lifted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    chain = _table(spark, d, "part").select(F.lit("c").alias("chrom"), (F.col("p_partkey") * 50).alias("start"), (F.col("p_partkey") * 50 + 40).alias("end"), F.concat(F.lit("d"), (F.col("p_size") % 3).cast("string")).alias("to_chrom"), _long("p_size").alias("offset"))
    start = F.col("l_partkey") * 50 + F.col("l_linenumber") * 3
    spans = _table(spark, d, "lineitem").select(F.lit("c").alias("chrom"), start.alias("start"), (start + _long("l_quantity") % 30).alias("end"), F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"))
    return annotation.lift(spans, chain, 1024)


@_query(f"""with {_CHAIN}, {_SPANS} select c.to_chrom as chrom, j.start + shift as start, j."end" + shift as "end", id, line from j join c on c.start <= j.start - 1 and j."end" <= c."end" """)
def lift_over(spark, d):
    """Spans moved by a table of aligned blocks."""
    return _lifted(spark, d)[0]


@_query(f"""with {_CHAIN}, {_SPANS} select * from j where not exists (select 1 from c where c.start <= j.start - 1 and j."end" <= c."end")""")
def lift_over_rejects(spark, d):
    return _lifted(spark, d)[1]


@_query("""with e as (select l_partkey f, l_orderkey % 50 s, l_linenumber % 2 side from lineitem), o as (select f, string_agg(distinct s || '-' || (s + 5), ';' order by s || '-' || (s + 5)) m, list(distinct s) l from e where side = 0 group by f),
  n as (select f, list(distinct s) l from e where side = 1 group by f) select o.f as gene_id, len(list_filter(o.l, lambda x: not list_contains(n.l, x))) = 0 contained from o join n using (f) where list_sort(o.l) <> list_sort(n.l)""")
def exon_makeup_diff(spark, d):
    """Genes whose exons differ between two tables, and whether the new ones hold all of the old."""
    rows = _table(spark, d, "lineitem").select(F.col("l_partkey").alias("gene_id"), (F.col("l_orderkey") % 50).alias("start"), (F.col("l_orderkey") % 50 + 5).alias("end"), (F.col("l_linenumber") % 2).alias("side"))
    old, new = (rejoin.exon_makeup(rows.where(F.col("side") == i)) for i in (0, 1))
    return rejoin.differing_makeup(old, new, ["gene_id"]).select("gene_id", "contained")


def _gtf(spark: SparkSession, d: str) -> DataFrame:
    """Line items as exons: a supplier is a gene, an order of its a transcript."""
    start = F.col("l_partkey") * 10
    text = F.format_string('gene_id "G%d"; transcript_id "T%d.%d"; note "x y";', F.col("l_suppkey"), F.col("l_suppkey"), F.col("l_orderkey") % 4)
    rows = _table(spark, d, "lineitem")
    return rows.select(F.lit("c").alias("chrom"), F.lit("s").alias("source"), F.when(F.col("l_linenumber") == 7, "CDS").otherwise("exon").alias("feature"), start.alias("start"), (start + _long("l_quantity") % 9).alias("end"), F.lit(".").alias("score"), F.lit("+").alias("strand"), F.lit(".").alias("frame"), text.alias("attributes"))


_EXONS = """x as (select 'G' || l_suppkey gene, 'T' || l_suppkey || '.' || l_orderkey % 4 transcript, l_partkey * 10 as start, l_partkey * 10 + cast(l_quantity as bigint) % 9 as "end" from lineitem where l_linenumber <> 7 and cast(l_quantity as bigint) % 9 > 0)"""
_MERGED_EXONS = """f as (select *, max("end") over (partition by transcript order by start, "end" rows between unbounded preceding and 1 preceding) p from x),
  i as (select *, sum(case when p is null or start - p >= 2 then 1 else 0 end) over (partition by transcript order by start, "end" rows unbounded preceding) g from f),
  m as (select transcript, min(start) as start, max("end") as "end" from i group by transcript, g)"""


@_query(f"""with {_EXONS}, {_MERGED_EXONS}, n as (select transcript, lag("end") over (partition by transcript order by start) + 1 as start, start - 1 as "end" from m)
  select 'c' chrom, start, "end", '+' strand, string_agg(distinct transcript, ',' order by transcript) transcripts from n where start is not null and "end" >= start group by start, "end" """)
def transcripts_per_intron(spark, d):
    """Introns of all transcripts with the transcripts that have them, from GTF rows."""
    return annotation.introns_of_gtf(_gtf(spark, d)).withColumn("transcripts", F.array_join("transcripts", ","))


@_query(f"""with {_EXONS}, e as (select * from x), n as (select transcript, lag("end") over (partition by transcript order by start, "end") + 1 as start, start - 1 as "end" from e), t as (select gene, transcript, sum("end" - start + 1) t, count(*) n from e group by 1, 2)
  select count(distinct gene) genes, count(distinct transcript) transcripts, avg("end" - start + 1) exon_length, (select avg("end" - start + 1) from n where start is not null and "end" >= start) intron_length, (select avg(t) from t) transcript_length, (select avg(n) from t) exons_per_transcript from e""")
def gtf_summary(spark, d):
    return annotation.gtf_statistics(annotation.exons_of_gtf(_gtf(spark, d)))


@_query("""with e as (select user_id, coalesce(sum(value) filter (where event_type = 'click'), 0) a, coalesce(sum(value) filter (where event_type = 'view'), 0) b, count(*) * 100 t from (select user_id, event_type, 1 as value from events) group by user_id)
  select user_id, cast(a as bigint) reads, cast(b as bigint) reads2, cast(t as bigint) total, cast(a + b as bigint) reads_both, round(100.0 * (a + b) / t, 1) reads_both_percent from e""")
def both_ends(spark, d):
    """Counts of two runs added, and their share of a total."""
    n = lambda kind: F.coalesce(F.sum(F.when(F.col("event_type") == kind, 1)), F.lit(0))
    rows = _table(spark, d, "events").groupBy("user_id").agg(n("click").alias("reads"), n("view").alias("reads2"), (F.count("*") * 100).alias("total"))
    return qc.both_ends(rows, ["reads"], "total")


@_query("""select prefix, cast(max(n) as bigint) as counter from (select lpad(cast(c_custkey % 1000 as varchar), 3, '0') k, count(*) n from customer group by 1),
  lateral (select string_agg(lpad(replace(bin(cast(substr(k, i, 1) as integer)), ' ', ''), 4, '0'), '' order by i) prefix from range(1, 4) t(i)) group by prefix""")
def next_counters(spark, d):
    """Each prefix's first free counter after ids were given."""
    samples = _table(spark, d, "customer").select(F.concat(F.lit("SRR"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("accession"), "c_custkey")
    return ids.next_counters(ids.assign(samples, 1, "c_custkey"))


@_query("""select 2 as n, count(*) as ids from customer where c_custkey % 3 = 0""")
def id_clashes(spark, d):
    """Ids that were given twice, where a third of the samples comes in again."""
    samples = _table(spark, d, "customer").select(F.concat(F.lit("SRR"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("accession"), "c_custkey")
    given = folders.rewritten(ids.assign(samples, 1, "c_custkey"), "ids")
    return ids.clashes(given.unionByName(given.where("c_custkey % 3 = 0"))).groupBy(F.col("n").cast("int").alias("n")).agg(F.count("*").alias("ids"))


_LETTER_BITS = "lpad(substr(bin(ord(substr({}, {}, 1))), 2), 6, '0')"


@_query(f"""with n as (select p_partkey, split_part(p_name, ' ', 1) || '-' || p_brand as name from part), a as (select *, regexp_replace(name, '[^A-Za-z0-9]', '', 'g') t from n)
  select p_partkey, {_LETTER_BITS.format('t', 'length(t) - 1')} || {_LETTER_BITS.format('t', 'length(t)')} as last_bits, {_LETTER_BITS.format('t', '1')} || {_LETTER_BITS.format('t', '2')} as first_bits, case when regexp_matches(name, '\\W|_') then '1' else '0' end as source_bit from a""")
def letter_prefixes(spark, d):
    """Bits of names that aren't archive accessions, from their end and their beginning, and their source bit."""
    name = F.concat_ws("-", F.split_part("p_name", F.lit(" "), F.lit(1)), "p_brand")
    return _table(spark, d, "part").select("p_partkey", scalars.accession_bits(name).alias("last_bits"), scalars.leading_bits(name).alias("first_bits"), scalars.source_bit(name).alias("source_bit"))


@_query("""select 'c' || l_suppkey || '|' || (l_partkey + 1) || '|' || (l_partkey + 100) || '|' || l_linestatus as exon from lineitem""")
def one_based_keys(spark, d):
    chrom = F.concat(F.lit("c"), F.col("l_suppkey").cast("string"))
    return _table(spark, d, "lineitem").select(scalars.one_based_key(chrom, F.col("l_partkey"), F.col("l_partkey") + 100, F.col("l_linestatus")).alias("exon"))


@_query("""select l_returnflag as annotation, count(*) as differences, count(*) <= 3000 as ok from lineitem where l_discount > 0.05 group by l_returnflag""")
def diff_bounds(spark, d):
    return checks.within(_table(spark, d, "lineitem").where("l_discount > 0.05").withColumnRenamed("l_returnflag", "annotation"), "annotation", 3000)


@_query("""select l_orderkey as sample, cast(l_quantity as bigint) as uniques, cast(l_quantity as bigint) + l_linenumber as "all" from lineitem""")
def coverage_choice(spark, d):
    """Both kinds of coverage of the aligner's rows; zeros stay."""
    raw = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("sample"), F.lit(1).alias("strand"), F.lit(1).alias("motif"), F.lit(0).alias("annotated"), _long("l_quantity").alias("num_uniques"), _long("l_linenumber").alias("num_multis"), F.lit(9).alias("max_overhang"))
    rows = junctions.reformat_aligner(raw)
    return rows.select("sample", junctions.coverage_of(rows, "unique").alias("uniques"), junctions.coverage_of(rows, "all").alias("all"))


@_query("""select l_orderkey as sample, cast(sum(cast(l_quantity as bigint)) as bigint) as value from lineitem where l_linenumber % 3 = 1 group by l_orderkey""")
def intron_sums(spark, d):
    """Introns put aside from the exons and summed by sample."""
    rows = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("sample"), (F.col("l_linenumber") % 3).alias("type"), _long("l_quantity").alias("value"))
    return matrix.reduce_axis(rejoin.split_types(rows)[1], ["sample"])


@_query("""select p_brand as feature, l_orderkey as sample, cast(sum(cast(l_quantity as bigint)) as bigint) cov from lineitem join part on p_partkey = l_partkey - 1 group by all""")
def one_based_rejoin(spark, d):
    """One-based counts summed by a mapping in BED coordinates."""
    counts = rejoin.from_zero(_table(spark, d, "lineitem").select(F.col("l_partkey").alias("start"), _long("l_quantity").alias("cov"), F.col("l_orderkey").alias("sample")))
    edges = _table(spark, d, "part").select(F.col("p_partkey").alias("start"), F.col("p_brand").alias("feature"))
    return rejoin.rejoin(counts, edges, ["start"], ["feature"])


@_query("""with r as (select 'c' chrom, p_partkey as start, p_partkey + p_size as "end", '+' strand, 'g' || p_partkey % 300 gene, p_size as bp_length from part),
  known as (select r.*, 'A1' annotation from r where p_ok(bp_length, 3) union all select r.*, 'B2' from r where p_ok(bp_length, 4)),
  n as (select *, row_number() over (partition by gene, annotation order by chrom, start, "end") k from known) select gene as gene_id, annotation, chrom, start + 1 as start, "end", strand, bp_length from n where k = 1""".replace("p_ok(bp_length, 3)", "bp_length % 3 <> 0").replace("p_ok(bp_length, 4)", "bp_length % 4 = 0"))
def genes_by_map(spark, d):
    """Gene rows for each annotation that a map has at their place for their gene; the first row of each pair stays."""
    part = _table(spark, d, "part").select(F.lit("c").alias("chrom"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size")).alias("end"), F.lit("+").alias("strand"), F.concat(F.lit("g"), (F.col("p_partkey") % 300).cast("string")).alias("gene"), F.col("p_size").alias("bp_length"))
    rows = part.withColumn("names", F.concat("gene", F.lit(".A1;unknown"))).drop("gene")
    place = ["chrom", "start", "end", "strand"]
    known = part.where("bp_length % 3 <> 0").select(*place, F.concat("gene", F.lit(".A1")).alias("name")).unionByName(part.where("bp_length % 4 = 0").select(*place, F.concat("gene", F.lit(".B2")).alias("name")))
    return rejoin.by_gene_map(rows, known, ["A1", "B2"]).select("gene_id", "annotation", *place, "bp_length")


@_query("""select g as gene_id, l_orderkey as sample, cast(sum(cast(l_quantity as bigint)) as bigint) cov from lineitem join (select p_partkey, unnest([p_brand, p_type]) g from part) on p_partkey = l_partkey group by all""")
def sums_by_gene_list(spark, d):
    """Sums of genes from a list of each exon's genes, joined by the exon's id."""
    genes = _table(spark, d, "part").select(F.col("p_partkey").alias("exon_id"), F.concat_ws(",", "p_brand", "p_type").alias("gene_ids"))
    sums = _table(spark, d, "lineitem").select(F.col("l_partkey").alias("exon_id"), F.col("l_orderkey").alias("sample"), _long("l_quantity").alias("cov"))
    return rejoin.sums_by_gene_list(sums, genes)


@_query("""with q as (select l_orderkey o, l_linenumber - 1 as position, cast(sum(case when l_discount < 0.02 then 0 else cast(l_quantity as bigint) end) as bigint) q from lineitem group by all)
  select o as gene_id, coalesce(string_agg(',' || (position * 11) || ':' || q, '' order by position) filter (where q > 0 and position < 6), '') samples from q group by o""")
def positions_to_packed(spark, d):
    """Counts by place in an array to ids by a map of places; places without an id are left out."""
    cov = F.when(F.col("l_discount") < 0.02, 0).otherwise(_long("l_quantity"))
    each = _table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("gene_id"), (F.col("l_linenumber") - 1).alias("p")).agg(F.sum(cov).alias("q"))
    wide = each.groupBy("gene_id").agg(F.map_from_entries(F.collect_list(F.struct("p", "q"))).alias("m")).select("gene_id", F.array(*(F.coalesce(F.col("m")[i], F.lit(0).cast("long")) for i in range(7))).alias("counts"))
    places = _table(spark, d, "lineitem").select((F.col("l_linenumber") - 1).alias("position")).distinct().where("position < 6").select("position", (F.col("position") * 11).alias("id"))
    return matrix.positions_to_packed(wide, ["gene_id"], "counts", places)


@_query("""select p_size, cast(count(*) filter (where p_partkey % 4 = 0) as bigint) "AFRICA", cast(count(*) filter (where p_partkey % 4 = 1) as bigint) "AMERICA", cast(count(*) filter (where p_partkey % 4 = 2) as bigint) "ASIA", cast(count(*) filter (where p_partkey % 4 = 3) as bigint) "EUROPE" from part group by p_size""")
def header_names(spark, d):
    """A wide table's numbered columns headed by the names that a table gives them."""
    long = _table(spark, d, "part").select("p_size", (F.col("p_partkey") % 4).cast("string").alias("c"), F.lit(1).cast("long").alias("v"))
    wide = matrix.long_to_wide(long, ["p_size"], "c", "v", ["0", "1", "2", "3"])
    return matrix.renamed_columns(wide, _table(spark, d, "region"), "r_regionkey", "r_name")


@_query("""select c_custkey as sample, c_nationkey as total, case when n is not null and c_nationkey > 0 then n else 0 end intron_sum, case when n is not null and c_nationkey > 0 then round(100.0 * n / c_nationkey, 2) else 0.0 end intron_sum_percent from customer left join (select o_custkey, count(*) n from orders where o_orderstatus = 'F' group by 1) on o_custkey = c_custkey""")
def intron_sum_in_qc(spark, d):
    rows = _table(spark, d, "customer").select(F.col("c_custkey").alias("sample"), F.col("c_nationkey").alias("total"))
    sums = _table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("sample")).agg(F.count("*").alias("intron_sum"))
    return metadata.with_intron_sums(rows, sums, "total")


@_query("""select l_partkey, cast(count(*) as bigint) as count, cast(sum(cast(l_quantity as bigint)) as bigint) as sum, avg(cast(l_quantity as bigint)) as avg, quantile_cont(cast(l_quantity as bigint), 0.5) as median from lineitem group by l_partkey""")
def gene_statistics(spark, d):
    """Statistics in full precision."""
    return junctions.sample_statistics(_table(spark, d, "lineitem").withColumn("cov", _long("l_quantity")), ["l_partkey"], places=None)


@_query("""with p as (select l_partkey, l_linenumber, ',' || string_agg(l_orderkey || ':' || cast(l_quantity as bigint), ',' order by l_orderkey, l_quantity) s from lineitem group by all)
  select l_partkey, string_agg(s, '' order by s) samples, (select count(*) from lineitem l where l.l_partkey = p.l_partkey) as count, (select cast(sum(cast(l_quantity as bigint)) as bigint) from lineitem l where l.l_partkey = p.l_partkey) as sum,
  (select round(avg(cast(l_quantity as bigint)), 3) from lineitem l where l.l_partkey = p.l_partkey) as avg, (select round(quantile_cont(cast(l_quantity as bigint), 0.5), 3) from lineitem l where l.l_partkey = p.l_partkey) as median from p group by l_partkey""")
def repaired_junctions(spark, d):
    """Rows of one junction that stood apart joined, their statistics computed anew."""
    entries = F.sort_array(F.collect_list(F.struct(F.col("l_orderkey").alias("sample"), _long("l_quantity").alias("cov"))))
    parts = _table(spark, d, "lineitem").groupBy("l_partkey", "l_linenumber").agg(scalars.pack_samples(entries).alias("samples"))
    return junctions.repaired(parts, ["l_partkey"])


def _logs(spark: SparkSession, d: str, kind: str) -> DataFrame:
    """Events as logs of a kind: one for each user, a line for each event in order."""
    line = {"star": F.format_string("  %s reads |\t%d", "event_type", "k"), "idxstats": F.format_string("chr%s\t9\t%d\t0", F.substr("event_type", F.lit(1), F.lit(1)), "k"), "bc_auc": F.format_string("%s\t%d", "event_type", "k"), "bc_frag": F.format_string("STAT\t%s\t%d", "event_type", "k")}[kind]
    rows = _table(spark, d, "events").select("user_id", "event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return rows.groupBy("user_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", line.alias("t")))), lambda x: x["t"]), "\n").alias("text"))


_LINES = """select user_id, '{kind}.' || n || case when i > 1 then i else '' end as key, k as value from (select user_id, {name} n, cast(json_extract_string(props, '$.k') as double) k, row_number() over (partition by user_id, {name} order by event_id) i from events)"""


@_query(_LINES.format(kind="star", name="event_type || '_reads'").replace("case when i > 1 then i else '' end", "case when i > 1 then cast(i as varchar) else '' end"))
def aligner_log(spark, d):
    """Lines of the aligner's log; a name that comes again is numbered."""
    return qc.log_lines(_logs(spark, d, "star"), "star")


@_query(_LINES.format(kind="idxstats", name="'chr' || substr(event_type, 1, 1)").replace("case when i > 1 then i else '' end", "case when i > 1 then cast(i as varchar) else '' end"))
def idxstats_log(spark, d):
    return qc.log_lines(_logs(spark, d, "idxstats"), "idxstats")


@_query(f"""select * from ({_LINES.format(kind='bc_auc', name='event_type')} union all {_LINES.format(kind='bc_frag', name='event_type')})""".replace("case when i > 1 then i else '' end", "case when i > 1 then cast(i as varchar) else '' end"))
def coverage_logs(spark, d):
    return qc.log_lines(_logs(spark, d, "bc_auc"), "bc_auc").unionByName(qc.log_lines(_logs(spark, d, "bc_frag"), "bc_frag"))


@_query("""select p_partkey, 'gene_fc_count_all.' || k as key, v as value from (select p_partkey, unnest(['total', 'assigned']) k, unnest([p_size * 10.0, p_size * 7.0]) v from part)""")
def counter_log(spark, d):
    """The two numbers of a feature counter's log."""
    text = F.format_string("||  Total alignments : %d   ||\n||  Successfully assigned alignments : %d (70.0%%)  ||", F.col("p_size") * 10, F.col("p_size") * 7)
    return qc.counter_lines(_table(spark, d, "part").select("p_partkey", text.alias("text")), "gene_fc_count_all")


@_query("""with e as (select user_id, event_type, cast(json_extract_string(props, '$.k') as double) k from events), w as (select user_id, coalesce(max(k) filter (where event_type = 'click'), 0) u, coalesce(max(k) filter (where event_type = 'view'), 0) m, coalesce(max(k) filter (where event_type = 'signup'), 0) a, max(k) filter (where event_type = 'error') x, max(k) filter (where event_type = 'purchase') y from e group by user_id)
  select user_id, u as uniquely, m as many, a as assigned, u + m as mapped, case when u + m <> 0 then round(100 * a / (u + m), 2) else 0.0 end as gene_percent, case when coalesce(x, 0) + coalesce(y, 0) = 0 or x is null then -1.0 else round(100.0 * x / (coalesce(x, 0) + coalesce(y, 0)), 2) end as x_percent from w""")
def qc_report(spark, d):
    """One row of quality figures for each sample: all mapped reads, a ratio, and a chromosome's share."""
    key = F.create_map(*map(F.lit, ("click", "star.Uniquely_mapped_reads_number", "view", "star.Number_of_reads_mapped_to_multiple_loci", "signup", "gene_fc_count_all.assigned", "error", "idxstats.chrX", "purchase", "idxstats.chrY")))
    long = _table(spark, d, "events").groupBy("user_id", key[F.col("event_type")].alias("key")).agg(F.max(F.get_json_object("props", "$.k").cast("double")).alias("value"))
    report = qc.report(long, ["user_id"], [("gene_fc.all_percent", "gene_fc_count_all.assigned", "star.All_mapped_reads")])
    names = {"star.Uniquely_mapped_reads_number": "uniquely", "star.Number_of_reads_mapped_to_multiple_loci": "many", "gene_fc_count_all.assigned": "assigned", "star.All_mapped_reads": "mapped", "gene_fc.all_percent": "gene_percent", "idxstats.chrX_percent": "x_percent"}
    return report.select("user_id", *(F.col(f"`{a}`").alias(b) for a, b in names.items()))


@_query("""with w as (select c_custkey k, c_nationkey n, c_nationkey % 3 n2, cast(c_acctbal as bigint) b from customer)
  select k as sample, cast(case when n + n2 > 0 then round(100.0 * (n // 2 + n2 // 2) / (n + n2)) else 0 end as bigint) all_reads_mapped, cast(case when n * 5 + n2 * 6 > 0 then round(100.0 * b / (n * 5 + n2 * 6)) else 0 end as bigint) all_bases_mapped,
  n + n2 as input, n || ':' || n2 as both_input_reads, n * 5 + n2 * 6 as all_bases from w""")
def qc_condensed(spark, d):
    n, n2 = F.col("c_nationkey"), F.col("c_nationkey") % 3
    rows = _table(spark, d, "customer").select(F.col("c_custkey").alias("sample"), n.alias("input"), n2.alias("input2"), F.expr("c_nationkey div 2").alias("mapped"), F.expr("(c_nationkey % 3) div 2").alias("mapped2"), F.round("c_acctbal").cast("long").alias("bases"), F.lit(5).alias("length"), F.lit(6).alias("length2"))
    return qc.condensed_report(rows, ["sample"], ["input"], "input", "mapped", "bases", "length")


_SQL["qc_condensed"] = _SQL["qc_condensed"].replace("cast(c_acctbal as bigint) b", "cast(round(c_acctbal) as bigint) b")


@_query("""select p_partkey, p_brand as source, p_type as transcript from part""")
def source_tags(spark, d):
    source, transcript = scalars.source_and_transcript(F.concat("p_brand", F.lit(":::"), "p_type"))
    return _table(spark, d, "part").select("p_partkey", source.alias("source"), transcript.alias("transcript"))


@_query("""select p_partkey, case when p_size between 20 and 33 then 'gC' || p_size when p_size < 10 then 'rG38' end as source from part where p_size between 20 and 33 or p_size < 10""")
def bundle_sources(spark, d):
    """Rows of an annotation bundle's files with their source codes; files without one go."""
    name = F.when(F.col("p_size") < 10, "hg38/refGene.txt.gz").otherwise(F.concat(F.lit("hg38/gencode.v"), F.col("p_size").cast("string"), F.lit(".annotation.gtf.gz")))
    codes = spark.createDataFrame(list(annotation.source_codes(33, 24).items()), "file string, source string")
    return annotation.with_source(_table(spark, d, "part").select("p_partkey", F.concat(F.lit("/data/"), name).alias("path")), codes).select("p_partkey", "source")


@_query("""select 's' || s_suppkey as file, 's' || s_suppkey || '.empty' as set_aside_as from supplier where s_suppkey not in (select l_suppkey from lineitem where l_discount = 0.1 and l_quantity = 50)""")
def quarantine(spark, d):
    """Outputs that no check found good, with the name that they are set aside under."""
    name = lambda c: F.concat(F.lit("s"), F.col(c).cast("string")).alias("file")
    return checks.quarantine(_table(spark, d, "supplier").select(name("s_suppkey")), _table(spark, d, "lineitem").where("l_discount = 0.1 and l_quantity = 50").select(name("l_suppkey")), "file")[1]


@_query("""select s_suppkey, case when s_acctbal > 0 then s_nationkey + 1 else s_nationkey end s_nationkey, s_acctbal > 0 changed from supplier""")
def guarded_update(spark, d):
    """New counts, where guarded keys, some of which have no new counts, must stay as they are."""
    old = _table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    new = _table(spark, d, "supplier").where("s_acctbal > 0").select("s_suppkey", (F.col("s_nationkey") + 1).alias("s_nationkey"))
    guard = [r[0] for r in old.join(new, "s_suppkey", "left_anti").orderBy("s_suppkey").limit(5).collect()]
    return rejoin.guarded_update(old, new, "s_suppkey", ["s_nationkey"], guard)


@_query("""with j as (select l_returnflag chrom, l_partkey as start, l_partkey + 100 as "end", 'x' || l_suppkey % 3 looked, ',' || l_orderkey || ':' || cast(l_quantity as bigint) samples, l_linestatus strand from lineitem)
  select chrom, start, "end", first(strand order by strand, looked, samples) strand, first(looked order by strand, looked, samples) motif, string_agg(samples, '' order by strand, looked, samples) samples from j group by chrom, start, "end" """)
def merge_with_looked_up_motif(spark, d):
    """A re-merge in which a looked-up motif overrides the one that rows carry."""
    rows = _table(spark, d, "lineitem").select(F.col("l_returnflag").alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + 100).alias("end"), F.col("l_linestatus").alias("strand"), F.lit("CC-CC").alias("motif"), F.concat(F.lit("x"), (F.col("l_suppkey") % 3).cast("string")).alias("looked"), F.concat(F.lit(","), F.col("l_orderkey").cast("string"), F.lit(":"), _long("l_quantity").cast("string")).alias("samples"))
    return junctions.merge_again([rows], motif="looked")


@_query("""select c_custkey * 3 as rail_id, c_nationkey as study, c_custkey as sample, c_mktsegment from customer where c_acctbal > 0""")
def metadata_rail_ids_skip(spark, d):
    """Samples without an id are left out."""
    rows = _table(spark, d, "customer").select(F.col("c_nationkey").alias("study"), F.col("c_custkey").alias("sample"), "c_mktsegment", "c_acctbal")
    return metadata.with_rail_ids(rows.drop("c_acctbal"), rows.where("c_acctbal > 0").select("study", "sample", (F.col("sample") * 3).alias("rail_id")), strict=False)


@_query("""select * exclude (l_orderkey, l_partkey, l_linenumber, l_quantity) from lineitem""")
def column_drop(spark, d):
    """Every column but those at some places, given as ranges of neighbours."""
    places = metadata.condensed([5, 1, 2, 4])
    return metadata.cut(_table(spark, d, "lineitem"), places, complement=True)


@_query("""select p_name, cast(sum(cast(floor(p_retailprice) as bigint)) as bigint) as value from part group by p_name""")
def value_sums(spark, d):
    """Values written with decimals, cut to whole numbers and summed by name."""
    cut = scalars.count_value(scalars.strip_decimals(F.col("p_retailprice").cast("string")))
    return matrix.reduce_axis(_table(spark, d, "part").select("p_name", cut.alias("value")), ["p_name"])


@_query("""select c_custkey, right(c_name, 2) lo, c_name as trimmed from customer""")
def trimmed_names(spark, d):
    name = F.concat(F.lit("UNCID"), "c_name", F.lit(".tar.gz"))
    trimmed = scalars.trim_decorations(name, [".tar.gz", "_rnaseq_fastq.tar", "TCGA", "UNCID"])
    return _table(spark, d, "customer").select("c_custkey", scalars.low_order(trimmed).alias("lo"), trimmed.alias("trimmed"))


@_query("""select p_partkey, case when p_size % 2 = 0 then 'chr' || p_size when p_size = 1 then 'chrM' else cast(p_size as varchar) end chrom, 'a "' || p_brand || '"; b "' || p_size || '"; ' as attributes from part""")
def renamed_annotation(spark, d):
    """Chromosome names of another assembly, and GFF attributes in GTF's form."""
    names = {str(i): f"chr{i}" for i in range(0, 51, 2)} | {"1": "chrM"}
    rows = _table(spark, d, "part").select("p_partkey", F.col("p_size").cast("string").alias("chrom"), F.concat(F.lit("a="), "p_brand", F.lit(";b="), F.col("p_size").cast("string")).alias("gff"))
    return annotation.renamed(rows, names).select("p_partkey", "chrom", annotation.gff_to_gtf(F.col("gff")).alias("attributes"))


@_query("""select p_partkey, cast(p_size as varchar) as score, 'G' || p_partkey as gene_id, 'c|' || p_partkey || '|' || p_partkey + p_size || '|+' as exon_key from part where p_size % 3 <> 0""")
def annotation_lengths(spark, d):
    """GTF rows scored by the length that sums give their gene, found by gene or by gene and chromosome."""
    part = _table(spark, d, "part")
    gtf = part.select(F.lit("c").alias("chrom"), F.lit("gene").alias("feature"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size")).alias("end"), F.lit(".").alias("score"), F.lit("+").alias("strand"), F.format_string('gene_id "G%d.A1";', "p_partkey").alias("attributes"), "p_partkey")
    sums = part.where("p_size % 3 <> 0").select(F.concat(F.format_string("G%d", "p_partkey"), F.when(F.col("p_size") % 3 == 1, "").otherwise(".c")).alias("gene_id"), F.col("p_size").alias("bp_length"))
    return metadata.annotation_with_lengths(gtf, sums, "gene", ["A1"]).select("p_partkey", "score", "gene_id", "exon_key")


@_query("""select l_orderkey as sample, l_partkey as key, cast(l_quantity as bigint) as cov from lineitem where l_partkey % 5 = 0""")
def unmapped_pieces(spark, d):
    """Pieces that no feature holds."""
    counts = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("sample"), F.col("l_partkey").alias("key"), _long("l_quantity").alias("cov"))
    return rejoin.unmapped(counts, _table(spark, d, "part").where("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("key")), ["key"]).select("sample", "key", "cov")


@_query()
def random_pick(spark, d):
    """Twenty random rows, for spot checks."""
    return metadata.pick(_table(spark, d, "orders").select("o_orderkey", "o_custkey"), 20, 7)


def _folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder for files that a query writes and reads."""
    return f"{folders.shared_folder(spark)}/{name}-{uuid4().hex}"


@_query(f"with {_J} select chrom, start, \"end\", name, cast(cov as varchar) cov, strand, motif, sample from j")
def junction_files(spark, d):
    """Junction files with headers and broken rows, one folder for each sample group, read by a manifest."""
    path = _folder(spark, "junctions")
    rows = _rows(spark, d)
    fields = F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "name", F.col("cov").cast("string"), "strand", "motif", F.col("sample").cast("string"))
    broken = F.when(F.col("start") % 5 == 0, F.array(fields, F.lit("chr1\tx\ty\tA"), F.lit("chr1"))).when(F.col("start") % 5 == 1, F.array(F.lit("chrom\tstart\tend\tname\tscore\tstrand\tsplice_site"), fields)).otherwise(F.array(fields))
    rows.select((F.col("sample") % 8).alias("group"), F.explode(broken).alias("value")).write.partitionBy("group").text(path, compression="gzip")
    found = readers.junction_bed(spark, path, rest="sample long")
    names = found.select("path").distinct()
    return readers.with_samples(found.withColumnRenamed("sample", "own"), names.select(F.col("path").alias("file"), F.lit(1).alias("sample")), parts=2).select("chrom", "start", "end", "name", "cov", "strand", "motif", F.col("own").alias("sample"))


_LETTERS = "upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g'))"


def _fasta(spark: SparkSession, d: str) -> DataFrame:
    """Documents' letters as FASTA records of sixty bases a line, read back in chunks."""
    path = _folder(spark, "genome")
    letters = F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""))
    record = F.concat(F.lit(">d"), F.col("doc_id").cast("string"), F.lit(" a document\n"), F.regexp_replace(letters, "(.{60})", "$1\n"))
    _table(spark, d, "documents").select(record.alias("value")).write.text(path)
    return readers.fasta_chunks(spark, path, 1000)


@_query(f"select 'd' || doc_id chrom, length({_LETTERS}) as size from documents where length({_LETTERS}) > 0")
def fasta_sizes(spark, d):
    return readers.chromosome_sizes(_fasta(spark, d), 1000)


@_query(f"""with g as (select 'd' || doc_id chrom, {_LETTERS} s from documents), j as (select chrom, s, length(s) // 3 + 1 as start, length(s) as "end" from g where length(s) > 3)
  select chrom, cast(start as bigint) as start, "end", s[cast(start as bigint):cast(start + 1 as bigint)] || '-' || s["end" - 1:"end"] motif from j""")
def fasta_motifs(spark, d):
    """Two bases at either end of a span of each record."""
    chunks = folders.rewritten(_fasta(spark, d), "chunks")
    spans = readers.chromosome_sizes(chunks, 1000).where("size > 3").select("chrom", F.expr("size div 3 + 1").alias("start"), F.col("size").alias("end"))
    return junctions.look_up_motifs(spans, chunks, 1000, unknown=False)


@_query("""select l_linenumber as sample, row_number() over (partition by l_linenumber order by l_orderkey, l_partkey, l_quantity) - 1 as line, cast(l_quantity as bigint) as sum from lineitem""")
def exon_sum_files(spark, d):
    """Sums of each sample's file with the place of their row; of the file one column is read."""
    path = _folder(spark, "sums")
    rows = _table(spark, d, "lineitem").repartition("l_linenumber").sortWithinPartitions("l_linenumber", "l_orderkey", "l_partkey", "l_quantity")
    rows.select(F.col("l_linenumber").alias("sample"), F.concat_ws("\t", F.lit("c"), F.lit("1"), F.lit("2"), _long("l_quantity").cast("string")).alias("value")).write.partitionBy("sample").text(path)
    return readers.exon_sums(spark, path).select(F.regexp_extract("path", r"sample=([0-9]+)", 1).cast("int").alias("sample"), "line", "sum")


@_query("""select 'S' || c_custkey as accession, 'ST' || c_nationkey as study, 'hg38' as reference, right('ST' || c_nationkey, 2) study_lo, right('S' || c_custkey, 2) run_lo from customer""")
def file_manifest(spark, d):
    path = F.concat(F.lit("/data/S"), F.col("c_custkey").cast("string"), F.lit("!ST"), F.col("c_nationkey").cast("string"), F.lit("!hg38!sra"))
    return readers.manifest(_table(spark, d, "customer").select(path.alias("path"))).drop("path")


@_query(f"""with {_EXONS} select gene, transcript, start, "end" from x""")
def gtf_file(spark, d):
    """Exons of a GTF file."""
    path = _folder(spark, "gtf")
    gtf = _gtf(spark, d)
    gtf.select(F.concat_ws("\t", *(F.col(c).cast("string") for c in gtf.columns)).alias("value")).write.text(path)
    return annotation.exons_of_gtf(readers.gtf(spark, path)).select("gene", "transcript", "start", "end")


@_query("""with e as (select p_brand as name, p_partkey * 10 s, p_partkey * 10 + p_size % 9 e from part), i as (select name, lag(e) over (partition by name order by s) + 1 as start, s as "end" from e) select 'c' chrom, '-' strand, start, "end", name as transcript from i where start is not null and "end" >= start""")
def gene_model_file(spark, d):
    """Introns of a file of gene models."""
    path = _folder(spark, "models")
    ends = F.sort_array(F.collect_list(F.struct((F.col("p_partkey") * 10).alias("s"), (F.col("p_partkey") * 10 + F.col("p_size") % 9).alias("e"))))
    listed = lambda f: F.concat(F.array_join(F.transform("x", lambda v: v[f].cast("string")), ","), F.lit(","))
    models = _table(spark, d, "part").groupBy("p_brand").agg(ends.alias("x")).select(F.concat_ws("\t", F.lit("0"), "p_brand", F.lit("c"), F.lit("-"), *[F.lit("0")] * 5, listed("s"), listed("e")).alias("value"))
    models.write.text(path)
    return annotation.introns_of_gene_pred(readers.gene_pred(spark, path)).select("chrom", "strand", "start", "end", "transcript")


@_query("""select cast(c_custkey as varchar) study_id, c_name as sample_name, c_mktsegment || ' x' as remarks from customer""")
def table_with_header(spark, d):
    """A metadata table whose header has capitals and blanks and whose cells hold line breaks."""
    path = _folder(spark, "metadata")
    rows = _table(spark, d, "customer").select(F.col("c_custkey").alias("Study ID"), F.col("c_name").alias("Sample Name"), F.concat("c_mktsegment", F.lit("\nx")).alias("remarks"))
    rows.coalesce(1).write.csv(path, sep="\t", header=True, quote='"', escape='"', quoteAll=True)
    return readers.table_with_header(spark, path)


@_query("""select p_type as chrom, p_partkey as start, p_partkey + p_size as "end", '+' as strand, case when p_size % 2 = 0 then p_brand else 'all' end as sources from part""")
def annotated_list(spark, d):
    """Annotated junctions of files with and without sources."""
    path = _folder(spark, "annotated")
    rows = _table(spark, d, "part")
    fields = ["p_type", F.col("p_partkey").cast("string"), (F.col("p_partkey") + F.col("p_size")).cast("string"), F.lit("+")]
    rows.select((F.col("p_size") % 2).alias("kind"), F.concat_ws("\t", *fields, F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))).alias("value")).write.partitionBy("kind").text(path)
    return readers.annotation_list(spark, path).select("chrom", "start", "end", "strand", "sources")


@_query("""select o_orderkey, o_custkey, o_orderpriority from orders""")
def sorted_table(spark, d):
    """A range-sorted table, and the same rows as compressed text."""
    path = _folder(spark, "sorted")
    rows = _table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    writers.range_sorted(rows, path, ["o_custkey", "o_orderkey"])
    writers.compressed_tsv(spark.read.parquet(path), f"{path}-text")
    return readers.tsv(spark, f"{path}-text", "o_custkey long, o_orderkey long, o_orderpriority string").drop("path")


@_query("""with l as (select dense_rank() over (order by l_suppkey) r, dense_rank() over (order by l_linenumber) c, cast(sum(cast(l_quantity as bigint)) as bigint) v from lineitem group by l_suppkey, l_linenumber)
  select r || chr(9) || c || chr(9) || v as line from l union all select '%%MatrixMarket matrix coordinate integer general' union all select '% sums' union all select max(r) || chr(9) || max(c) || chr(9) || count(*) from l""")
def matrix_market_file(spark, d):
    path = _folder(spark, "mm")
    long = _table(spark, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.sum(_long("l_quantity")).alias("v"))
    frames.matrix_market(matrix.sparse(long, ["l_suppkey"], "l_linenumber", "v")[0], path, " sums")
    return spark.read.text(path).withColumnRenamed("value", "line")


@_query("""select p_partkey || chr(9) || p_brand as line from part union all select '##annotation=A1' union all select 'p_partkey' || chr(9) || 'p_brand'""")
def preamble_file(spark, d):
    path = _folder(spark, "preamble")
    writers.with_preamble(_table(spark, d, "part").select("p_partkey", "p_brand"), path, ["annotation=A1"])
    return spark.read.text(path).withColumnRenamed("value", "line")


@_query("""select event_type, count(*) as n from events group by event_type""")
def whole_logs(spark, d):
    """Log files read whole, and how many values each gives."""
    path = _folder(spark, "logs")
    _table(spark, d, "events").repartition("event_type").select("event_type", F.col("props").alias("value")).write.partitionBy("event_type").text(path)
    logs = readers.texts(spark, path).select(F.regexp_extract("path", "event_type=([a-z]+)", 1).alias("event_type"), "text")
    return qc.metrics(logs, {"k": r'"k": (\d+)'}).groupBy("event_type").agg(F.count("*").alias("n"))


def _triplet(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    samples = _table(spark, d, "customer").select((F.col("c_custkey") * 3).alias("rail_id"), F.col("c_custkey").cast("string").alias("sample"), F.col("c_nationkey").cast("string").alias("study"), "c_mktsegment", "c_acctbal")
    own = ["sample", "study"]
    tables = metadata.per_study(samples, samples.select(*own, "c_mktsegment"), samples.select(*own, "c_acctbal"), "human", "sra", "sra", "2020-01-01", F.lit("data_sources/x"))
    path = _folder(spark, "triplet")
    writers.metadata_triplet(tables, path)
    return {k: spark.read.parquet(f"{path}/{k}") for k in tables}


@_query("""select c_custkey * 3 as rail_id, cast(c_custkey as varchar) external_id, cast(c_nationkey as varchar) as study, right(cast(c_nationkey as varchar), 2) study_lo, c_mktsegment from customer""")
def metadata_source(spark, d):
    """The source table of each study, from its own folder."""
    return _triplet(spark, d)["source"].select("rail_id", "external_id", F.col("study").cast("string").alias("study"), F.col("study_lo").cast("string").alias("study_lo"), "c_mktsegment")


@_query("""select c_custkey * 3 as rail_id, cast(c_custkey as varchar) external_id, c_acctbal from customer""")
def metadata_quality(spark, d):
    return _triplet(spark, d)["qc"].select("rail_id", "external_id", "c_acctbal")


_UNIFIED = """s as (select l_orderkey % 20 as sample, l_partkey p, cast(sum(cast(l_quantity as bigint)) as bigint) q from lineitem group by all),
  k as (select * from s join (select p_partkey, p_size % 4 = 1 intron from part) on p = p_partkey where sample < 15),
  e as (select p, p // 5 * 50 f_start, p // 5 * 50 + 50 f_end, 'g' || p // 5 gene from k where not intron group by all)"""


def _unified(spark: SparkSession, d: str, of: Column | None = None) -> dict[str, DataFrame]:
    """Sums of pieces, five to a gene, of which some are introns; two samples' files have a piece twice."""
    rows = _table(spark, d, "lineitem").select((F.col("l_orderkey") % 20).alias("sample"), F.col("l_partkey").alias("exon_id"), _long("l_quantity").alias("q"))
    sums = rows.groupBy("sample", "exon_id").agg(F.sum("q").alias("sum"))
    sums = sums.withColumn("line", F.lit(0)).unionByName(sums.where("sample < 2").withColumn("line", F.lit(1)))
    part = _table(spark, d, "part")
    place = [F.lit("c").alias("chrom"), (F.col("p_partkey") * 10).alias("start"), (F.col("p_partkey") * 10 + 9).alias("end"), F.lit("+").alias("strand")]
    exons = part.select(F.col("p_partkey").alias("exon_id"), *place, F.when(F.col("p_size") % 4 == 1, 1).otherwise(0).alias("type"))
    gene = F.expr("p_partkey div 5")
    feature = [F.lit("c").alias("f_chrom"), (gene * 50).alias("f_start"), (gene * 50 + 50).alias("f_end"), F.lit("+").alias("f_strand")]
    edges = part.select(*place, *feature, F.concat(F.lit("g"), gene.cast("string"), F.lit(".A1")).alias("name"))
    gene_map = edges.select(F.col("f_chrom").alias("chrom"), F.col("f_start").alias("start"), F.col("f_end").alias("end"), F.col("f_strand").alias("strand"), "name").distinct()
    samples = sums.where("sample < 15").select("sample").distinct()
    if of is not None:
        samples = samples.where(of)
    return unify.gene_and_exon_sums(sums, exons, samples, edges, edges, gene_map, ["A1"], ["line"])


@_query(f"""with {_UNIFIED} select gene as gene_id, 'A1' as annotation, f_start + 1 as start, f_end as "end", sample, cast(sum(q) as bigint) as sum from k join e using (p) where not intron group by all""")
def gene_sums(spark, d):
    """Gene sums from pieces: introns aside, repeated pieces once, unlisted samples left out."""
    return _unified(spark, d)["genes"].select("gene_id", "annotation", "start", "end", "sample", "sum")


@_query(f"""with {_UNIFIED}, g as (select gene, sample, cast(sum(q) as bigint) v from k join e using (p) where not intron group by all), f as (select distinct 'g' || p_partkey // 5 gene from part), c as (select distinct sample from s where sample < 15)
  select f.gene as gene_id, c.sample, coalesce(v, 0) as value from f cross join c left join g on g.gene = f.gene and g.sample = c.sample""")
def gene_sums_filled(spark, d):
    """Every gene and sample, with zero where nothing was measured."""
    made = _unified(spark, d)
    samples = made["introns"].select("sample").unionByName(made["genes"].select("sample")).distinct().withColumn("study", F.lit("all"))
    rows = unify.study_rows(made["genes"], made["gene_features"].select("gene_id"), samples, ["gene_id"])
    return rows.select("gene_id", F.explode(F.arrays_zip("samples", "counts")).alias("x")).select("gene_id", F.col("x.samples").alias("sample"), F.col("x.counts").alias("value"))


@_query(f"""with {_UNIFIED} select sample, cast(sum(q) * case when sample < 2 then 2 else 1 end as bigint) as value from k where intron group by sample""")
def tranche_intron_sums(spark, d):
    """Intron sums of two tranches of samples, put together; a piece that a file lists twice counts twice in them."""
    tranches = [_unified(spark, d, F.col("sample") % 2 == i) for i in (0, 1)]
    return unify.across_tranches(tranches)["introns"]


@_query("""with s as (select l_partkey k, cast(sum(cast(l_quantity as bigint)) as bigint) v from lineitem where l_discount > 0.09 group by 1) select p_partkey as exon_id, coalesce(v, 0) as value from part left join s on k = p_partkey""")
def filled_sums(spark, d):
    """Sums of every exon, zero where a file had none."""
    sums = _table(spark, d, "lineitem").where("l_discount > 0.09").groupBy(F.col("l_partkey").alias("exon_id")).agg(F.sum(_long("l_quantity")).alias("value"))
    return matrix.filled(sums, _table(spark, d, "part").select(F.col("p_partkey").alias("exon_id")), "exon_id")


@_query("""select 'c' || l_suppkey % 10 as chrom, l_partkey as start, l_partkey + l_linenumber - 2 as "end", l_linestatus strand, string_agg(distinct l_returnflag, ',' order by l_returnflag) sources from lineitem where l_linenumber >= 2 and l_suppkey % 10 < 7 group by all""")
def known_chromosomes(spark, d):
    """Junctions of several sources, valid ones on the chromosomes that a sizes file lists."""
    path = _folder(spark, "sizes")
    chrom = F.concat(F.lit("c"), (F.col("l_suppkey") % 10).cast("string"))
    rows = _table(spark, d, "lineitem").select(chrom.alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + F.col("l_linenumber") - 2).alias("end"), F.col("l_linestatus").alias("strand"), F.col("l_returnflag").alias("source"))
    rows.where("chrom < 'c7'").groupBy("chrom").agg(F.max("end").alias("size")).select(F.concat_ws("\t", "chrom", F.col("size").cast("string")).alias("value")).write.text(path)
    return annotation.unite_sources(rows, readers.sizes(spark, path))


@_query(f"with {_J} {_MERGED}")
def merged_file(spark, d):
    """A merged table written as text and read again."""
    path = _folder(spark, "merged")
    writers.compressed_tsv(junctions.merge_packed(_rows(spark, d)), path)
    return readers.merged_junctions(spark, path)


@_query("""with n as (select event_type as study, count(distinct user_id) as n from events group by 1) select study, n from n where study <> 'view'""")
def ready_stream(spark, d):
    """Studies whose finished samples, read as a stream, are as many as expected; of one more are expected than come."""
    stream = spark.readStream.schema(_table(spark, d, "events").schema).parquet(f"{d}/events.parquet*").select(F.col("event_type").alias("study"), F.col("user_id").cast("string").alias("sample"))
    expected = _table(spark, d, "events").groupBy(F.col("event_type").alias("study")).agg((F.count_distinct("user_id") + F.max(F.when(F.col("event_type") == "view", 1).otherwise(0))).alias("n"))
    return readiness.ready_in(readiness.counts_of(stream, _folder(spark, "ready")), expected)


@_query("""with r as (select l_returnflag chrom, l_partkey * 1000 + l_orderkey % 1000 as start, l_partkey * 1000 + l_orderkey % 1000 + cast(l_quantity as bigint) as "end", l_orderkey id from lineitem),
  q as (select 'A' chrom, p_partkey * 1000 + 100 as start, p_partkey * 1000 + 130 as "end" from part where p_size = 7)
  select q.start start_r, q."end" end_r, r.id, r.start from q join r on r.chrom = q.chrom and r.start < q."end" and q.start < r."end" """)
def region_lookup(spark, d):
    """Rows of an indexed table that many regions overlap; only files and row groups that may hold some are read."""
    start = F.col("l_partkey") * 1000 + F.col("l_orderkey") % 1000
    rows = _table(spark, d, "lineitem").select(F.col("l_returnflag").alias("chrom"), start.alias("start"), (start + _long("l_quantity")).alias("end"), F.col("l_orderkey").alias("id"))
    path = _folder(spark, "indexed")
    indexed.write(rows, path, block_rows=1000)
    regions = _table(spark, d, "part").where("p_size = 7").select(F.lit("A").alias("chrom"), (F.col("p_partkey") * 1000 + 100).alias("start"), (F.col("p_partkey") * 1000 + 130).alias("end"))
    return indexed.overlapping(spark, path, regions).select("start_r", "end_r", "id", "start")


@_query("""with e as (select event_type as study, count(distinct user_id) n from events group by 1) select study from e where study <> 'view'""")
def studies_once(spark, d):
    """Ready studies of a stream of several batches, each in the file sink once; of one study more samples are expected than come."""
    markers = _table(spark, d, "events").select(F.col("event_type").alias("study"), F.col("user_id").cast("string").alias("sample"))
    path = _folder(spark, "markers")
    markers.repartition(3).write.parquet(f"{path}/in")
    expected = markers.groupBy("study").agg((F.count_distinct("sample") + F.max(F.when(F.col("study") == "view", 1).otherwise(0))).alias("n"))
    stream = readiness.markers(spark, f"{path}/in", fmt="parquet", per_trigger=1)
    readiness.write_ready(stream, expected, f"{path}/out", f"{path}/progress").awaitTermination()
    return spark.read.schema("study string, n long").parquet(f"{path}/out").select("study")


_SQL["saved_rail_ids"] = _SQL["rail_ids"].replace("order by c_custkey) - 1 as counter", "order by c_custkey % 2, c_custkey) - 1 as counter").replace("select accession, c_custkey, prefix,", "select accession, c_custkey,")


@_query(_SQL["saved_rail_ids"])
def saved_rail_ids(spark, d):
    """Ids given in two runs, of even and of odd numbers, with counters kept between them; a third run gives all of them again as they are."""
    samples = _table(spark, d, "customer").select(F.concat(F.lit("SRR"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("accession"), "c_custkey")
    state = _folder(spark, "counters")
    for run in (samples.where("c_custkey % 2 = 0"), samples.where("c_custkey % 2 = 1")):
        ids.assign_saved(run, 1, "c_custkey", state)
    return ids.assign_saved(samples, 1, "c_custkey", state).select("accession", "c_custkey", "counter", "rail_id")


_PACKED = """select l_partkey, string_agg(',' || l_orderkey || ':' || cast(l_quantity as bigint), '' order by l_orderkey, l_linenumber, cast(l_quantity as bigint)) samples, count(*) n, cast(sum(cast(l_quantity as bigint)) as bigint) total from lineitem where l_linenumber <= {} group by l_partkey"""


@_query(f"""with d1 as ({_PACKED.format(1)}), d2 as ({_PACKED.format(2)}), d3 as ({_PACKED.format(7)})
  select 'P' || p_partkey as gene, p_name as place, case when p_partkey % 4 = 0 and d3.n is not null then d3.samples when p_partkey % 3 = 0 and d2.n is not null then d2.samples when p_partkey % 2 = 0 and d1.n is not null then d1.samples else '' end samples,
  case when p_partkey % 4 = 0 and d3.n is not null then d3.n when p_partkey % 3 = 0 and d2.n is not null then d2.n when p_partkey % 2 = 0 and d1.n is not null then d1.n else 0 end n,
  case when p_partkey % 4 = 0 and d3.n is not null then d3.total when p_partkey % 3 = 0 and d2.n is not null then d2.total when p_partkey % 2 = 0 and d1.n is not null then d1.total else 0 end total
  from part left join d1 on d1.l_partkey = p_partkey left join d2 on d2.l_partkey = p_partkey left join d3 on d3.l_partkey = p_partkey""")
def packed_upserts(spark, d):
    """Packed samples and their statistics replaced together by three upserts, the last one after a compaction."""
    lines, path = _table(spark, d, "lineitem"), _folder(spark, "deltas")
    entries = F.sort_array(F.collect_list(F.struct("l_orderkey", "l_linenumber", _long("l_quantity").alias("cov"), F.col("l_orderkey").alias("sample"))))
    gene = F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("gene")
    packed = lambda k: lines.where(F.col("l_linenumber") <= k).groupBy("l_partkey").agg(scalars.pack_samples(entries).alias("samples"), F.count("*").alias("n"), F.sum(_long("l_quantity")).alias("total")).withColumn("gene", gene)
    base = _table(spark, d, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("gene"), F.col("p_name").alias("place"), F.lit("").alias("samples"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"))
    table = deltas.KeyedTable(spark, path)
    table.create(base, ["gene"], ["samples", "n", "total"])
    for most, every in ((1, 2), (2, 3), (7, 4)):
        if every == 4:
            table.compact()
        table.upsert(packed(most).where(F.col("l_partkey") % every == 0).select("gene", "samples", "n", "total"))
    return table.read()


@_query("""select p_partkey, case when p_size % 2 = 0 then p_partkey || chr(9) || 'G' || p_partkey || ':' || p_brand || chr(9) || ',9:' || p_size || chr(9) || '1' when p_size % 3 = 0 then p_partkey || chr(9) || 'G' || p_partkey || ':' || p_brand || chr(9) || ',1:2,3:4' || chr(9) || '2' else p_partkey || chr(9) || 'none' end as line from part""")
def updated_lines(spark, d):
    """Text lines whose samples are replaced by key; a key stands between the last tab before the samples and the first colon."""
    part, key = _table(spark, d, "part"), F.concat(F.lit("G"), F.col("p_partkey").cast("string"))
    number = F.col("p_partkey").cast("string")
    lines = part.select("p_partkey", F.when((F.col("p_size") % 2 == 0) | (F.col("p_size") % 3 == 0), F.concat(number, F.lit("\t"), key, F.lit(":"), F.col("p_brand"), F.lit("\t,1:2,3:4\t2"))).otherwise(F.concat(number, F.lit("\tnone"))).alias("line"))
    updates = part.where("p_size % 2 = 0").select(key.alias("key"), F.concat(F.lit(",9:"), F.col("p_size").cast("string"), F.lit("\t1")).alias("new"))
    return deltas.updated_lines(lines, updates)


_MOVED = """c as (select 'c' chrom, p_partkey * 50 as s, p_partkey * 50 + 40 as e, 'd' || p_partkey // 40 % 3 to_chrom, p_partkey // 40 as chain, 1000000 as size, p_partkey // 40 % 2 = 1 minus, p_partkey * 60 as t from part),
  j as (select distinct l_orderkey % 50 id, l_partkey * 50 + l_linenumber * 6 as s, (l_partkey + l_linenumber) * 50 + cast(l_quantity as bigint) % 45 as e, translate(l_linestatus, 'OF', '+-') strand from lineitem),
  p as (select j.*, a.chain, a.to_chrom, a.minus, a.size, a.t + j.s - 1 - a.s x, b.t + j.e - 1 - b.s y from j join c a on j.s - 1 >= a.s and j.s - 1 < a.e join c b on a.chain = b.chain and j.e - 1 >= b.s and j.e - 1 < b.e)"""


def _chained(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Spans over several blocks, lifted by chains of which every other one goes to a minus strand."""
    part = _table(spark, d, "part")
    chain = F.expr("p_partkey div 40")
    chains = part.select(chain.alias("chain"), F.lit(1).alias("score"), F.lit("c").alias("chrom"), (F.col("p_partkey") * 50).alias("start"), (F.col("p_partkey") * 50 + 40).alias("end"), F.concat(F.lit("d"), (chain % 3).cast("string")).alias("to_chrom"), F.lit(1000000).alias("to_size"), F.when(chain % 2 == 1, "-").otherwise("+").alias("to_strand"), (F.col("p_partkey") * 60).alias("to_start"))
    spans = _table(spark, d, "lineitem").select((F.col("l_orderkey") % 50).alias("id"), F.lit("c").alias("chrom"), (F.col("l_partkey") * 50 + F.col("l_linenumber") * 6).alias("start"), ((F.col("l_partkey") + F.col("l_linenumber")) * 50 + _long("l_quantity") % 45).alias("end"), F.translate("l_linestatus", "OF", "+-").alias("strand"))
    return annotation.lift_ends(spans, chains, 1024)


@_query(f"""with {_MOVED} select id, to_chrom as chrom, case when minus then size - y else x + 1 end as start, case when minus then size - x else y + 1 end as "end", case when minus then translate(strand, '+-', '-+') else strand end strand from p""")
def lift_by_chains(spark, d):
    """Both ends of a junction moved apart, by one chain; minus strands turn it round."""
    return _chained(spark, d)[0]


@_query(f"""with {_MOVED} select id, 'c' as chrom, s as start, e as "end", strand from j except select id, 'c', s, e, strand from p""")
def lift_by_chains_rejects(spark, d):
    return _chained(spark, d)[1]


@_query("""with l as (select l_linenumber % 3 study, l_suppkey sample, l_partkey % 60 exon, cast(sum(cast(l_quantity as bigint)) as bigint) v from lineitem group by all),
  n as (select l_partkey % 60 exon, 'A' || l_suppkey % 2 + 1 as annotation, count(distinct l_suppkey % 6) m from lineitem where l_orderkey % 7 = 0 group by all),
  s as (select distinct study, sample from l), r as (select exon, annotation, unnest(range(1, m + 1)) as copy from n)
  select cast(s.study as varchar) study, r.annotation, r.exon, r.copy, s.study || '/' || s.sample as sample, coalesce(v, 0) as value from s cross join r left join l on l.study = s.study and l.sample = s.sample and l.exon = r.exon""")
def exon_splits(spark, d):
    """Exon sums of two tranches in files by study and annotation, each exon as often as an annotation lists it, read back."""
    lines = _table(spark, d, "lineitem").select((F.col("l_linenumber") % 3).cast("string").alias("study"), F.col("l_suppkey").alias("own"), (F.col("l_partkey") % 60).alias("exon"), _long("l_quantity").alias("q"), "l_orderkey", "l_suppkey")
    lines = lines.withColumn("sample", F.concat_ws("/", "study", F.col("own").cast("string")))
    half = lambda i: lines.where(F.col("own") % 2 == i)
    tranches = [(half(i).groupBy("exon", "sample").agg(F.sum("q").alias("sum")), half(i).select("study", "sample").distinct()) for i in (0, 1)]
    gene = F.concat(F.lit("G"), (F.col("l_suppkey") % 6).cast("string"), F.lit(".A"), (F.col("l_suppkey") % 2 + 1).cast("string"))
    names = lines.where("l_orderkey % 7 = 0").select("exon", gene.alias("gene")).distinct()
    rows = unify.exon_splits(tranches, lines.select("exon").distinct(), names, ["A1", "A2"])
    path = _folder(spark, "exon-splits")
    unify.write_studies(rows, path, ["exon", "copy"], kind="exon_sums")
    return readers.study_cells(spark, path, ["exon", "copy"]).select("study", "annotation", _long("exon").alias("exon"), _long("copy").alias("copy"), "sample", _long("value").alias("value"))


@_query("select doc_id from documents where exists (select 1 from (select distinct split_part(p_name, ' ', 1) w from part) where contains(lower(text), lower(w)))")
def literal_filter(spark, d):
    """Documents that hold some part's first word anywhere, in either case, by an automaton for each fifty words."""
    words = _table(spark, d, "part").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("w"))
    return joins.filter_by_literals(_table(spark, d, "documents").select("doc_id", "text"), "text", words, "w", ignore_case=True, most=50).select("doc_id")


@_query("""with l as (select dense_rank() over (order by l_orderkey) r, dense_rank() over (order by l_suppkey) c, cast(sum(cast(l_quantity as bigint)) as bigint) v from lineitem group by l_orderkey, l_suppkey)
  select count(*) as entries, 0 as blanks, min(r) first_row, max(r) last_row, min(c) first_column, max(c) last_column, true as ok from l""")
def matrix_written(spark, d):
    """A sparse matrix written and checked by one job, the figures of which are observed while it writes."""
    long = _table(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sum(_long("l_quantity")).alias("value"))
    triples, rows, columns = matrix.sparse(long, ["l_orderkey"], "l_suppkey", "value")
    figures = checks.matrix_written(triples, _folder(spark, "checked"), rows.count(), columns.count())
    names = ["entries", "blanks", "first_row", "last_row", "first_column", "last_column"]
    return spark.createDataFrame([(*(figures[n] for n in names), figures["ok"])], ", ".join([*(f"{n} long" for n in names), "ok boolean"]))


@_query("""select o_orderkey, o_custkey from orders where cast(o_custkey % 10 as varchar) in ('3', '7')""")
def of_studies(spark, d):
    """Rows of two studies, by equality."""
    orders = _table(spark, d, "orders").withColumn("study", (F.col("o_custkey") % 10).cast("string"))
    return metadata.of_studies(orders, ["3", "7"]).select("o_orderkey", "o_custkey")


@_query("""select p_partkey, 'seqtk.' || k as key, v as value from (select p_partkey, unnest(['avgQ', 'errQ', 'avgQ2', 'errQ2']) k, unnest([p_size + 0.5, p_size + 0.25, p_size + 1.5, p_size + 1.25]) v from part)""")
def read_quality_log(spark, d):
    """Mean and error quality of both reads from their table's ALL lines."""
    line = "ALL\t%d\t25.0\t25.0\t25.0\t24.9\t0.1\t%d.5\t%d.25\t0.0\t99.9"
    text = F.format_string(f"min_len: 100\nPOS\tbases\n{line}\n1\t9\n{line}", F.lit(900), "p_size", "p_size", F.lit(800), F.col("p_size") + 1, F.col("p_size") + 1)
    return qc.read_quality(_table(spark, d, "part").select("p_partkey", text.alias("text")))


@_query(f"""with {_J}, m as (select distinct chrom, start, "end", first(strand order by {_TIE}) over (partition by chrom, start, "end") strand, first(motif order by {_TIE}) over (partition by chrom, start, "end") motif from j)
  select dense_rank() over (order by chrom, start, "end") row_idx, chrom as chromosome, start, "end", "end" + 1 - start as length, strand, 0 as annotated, upper(split_part(motif, '-', 1)) left_motif, upper(split_part(motif, '-', 2)) right_motif, '0' left_annotated, '0' right_annotated from m""")
def row_attributes(spark, d):
    """The ten attributes of a junction matrix's rows."""
    merged = folders.rewritten(junctions.merge_packed(_rows(spark, d)), "merged")
    none = spark.createDataFrame([], "chrom string, start long, end long, sources string")
    annotated = junctions.annotate(merged.drop("samples"), none)
    rows = ranges.numbered(merged.select("chrom", "start", "end"), ["chrom", "start", "end"], "row_idx", 1)
    return matrix.row_attributes(rows, annotated)


@_query("""select o_custkey % 10 as chrom, o_orderkey % 7 as start, o_orderkey, row_number() over (order by o_custkey % 10, o_orderkey % 7, o_orderkey) - 1 as place from orders""")
def stable_order(spark, d):
    """Rows alike in their coordinates keep their order of arrival in a sorted table; place counts them as they are read."""
    path = _folder(spark, "stable")
    rows = _table(spark, d, "orders").select((F.col("o_custkey") % 10).alias("chrom"), (F.col("o_orderkey") % 7).alias("start"), "o_orderkey")
    writers.range_sorted(rows, path, line="o_orderkey")
    read = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_f"), F.col("_metadata.row_index").alias("_r"))
    return ranges.numbered(read, ["_f", "_r"], "place").drop("_f", "_r")


@_query("""select l_linenumber as file, row_number() over (partition by l_linenumber order by l_orderkey, l_partkey, l_suppkey) - 1 as line, l_orderkey, l_partkey, l_suppkey from lineitem""")
def zstd_files(spark, d):
    """Zstandard text of many frames, one file for each number, read in parts with true line numbers."""
    path = _folder(spark, "zstd")
    columns = ["l_orderkey", "l_partkey", "l_suppkey"]
    text = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    frames.zstd_files(_table(spark, d, "lineitem").select("l_linenumber", *columns), path, "l_linenumber", columns, text, 20_000)  # frames end inside lines
    read = readers.zstd_tsv(spark, path, columns, part_bytes=10_000)
    return read.select(F.regexp_extract("path", r"n([0-9]+)\.zst$", 1).cast("int").alias("file"), "line", *(_long(c).alias(c) for c in columns))


@_query("""select l_orderkey, cast(count(*) as bigint) as n, cast(sum(o_custkey) as bigint) as k from lineitem join orders on l_orderkey = o_orderkey group by l_orderkey""")
def bucketed_tables(spark, d):
    """Two catalogue tables in buckets of one key, joined and grouped without a shuffle of either."""
    name = f"tallyweave_{uuid4().hex}"
    writers.table(_table(spark, d, "lineitem").select("l_orderkey"), f"{name}_l", ["l_orderkey"], 8)
    writers.table(_table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), f"{name}_o", ["l_orderkey"], 8)
    joined = folders.rewritten(spark.table(f"{name}_l").join(spark.table(f"{name}_o"), "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("k")), "joined")
    for t in (f"{name}_l", f"{name}_o"):
        spark.sql(f"drop table {t}")
    return joined
