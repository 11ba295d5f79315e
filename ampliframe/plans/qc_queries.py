"""Read-QC and statistics queries with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampliframe.operators import read_qc as qc
from ampliframe.operators import seq_stats as st
from ampliframe.plans.fixtures import view

LENGTH = "sequence_length_template"
LOW, HIGH = 1200, 8000
#: barcode11 lies outside the declared levels, barcode96 has no reads
LEVELS = qc.declared_levels([*range(1, 11), 96])


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_summary")


def _counts(spark, sf_dir):
    levels = qc.levels_table(spark, LEVELS)
    return qc.read_counts(_summary(spark, sf_dir), levels, "alias", LENGTH, LOW, HIGH)


def read_counts_by_sample(spark, sf_dir):
    return _counts(spark, sf_dir)


def qc_long_metrics(spark, sf_dir):
    return qc.long_metrics(_counts(spark, sf_dir)).withColumn("value", F.round("value", 9))


def demux_recovery(spark, sf_dir):
    table = qc.length_frequencies(_summary(spark, sf_dir), "alias", LENGTH)
    numbers = qc.run_numbers(table, qc.levels_table(spark, LEVELS), LOW, HIGH)
    return numbers.withColumn("recovery", F.round("recovery", 9))


def length_histogram_log10(spark, sf_dir):
    table = qc.length_frequencies(_summary(spark, sf_dir), "alias", LENGTH)
    return qc.histogram_of(table, qc.levels_table(spark, LEVELS), LOW, HIGH)


def observed_levels(spark, sf_dir):
    kept = qc.filter_read_length(_summary(spark, sf_dir), LENGTH, LOW, HIGH)
    return qc.observed_levels(kept, "alias", ["read_id"])


def length_filtered_reads(spark, sf_dir):
    return qc.filter_read_length(_summary(spark, sf_dir), LENGTH, LOW, HIGH)


def eligible_reads(spark, sf_dir):
    reads = view(spark, sf_dir, "fx_seq")
    kept = qc.eligible_reads(
        reads,
        "source",
        F.length("seq"),
        st.mean_quality("qual"),
        1000,
        3300,
        8,
        16,
        quality_as="mean_quality",
    )
    return kept.select(
        "doc_id",
        "source",
        F.length("seq").alias("length"),
        F.round("mean_quality", 6).alias("mean_quality"),
    )


def _rounded(df: DataFrame) -> DataFrame:
    wanted = {"avg_len", "gc_pct", "q20_pct", "q30_pct", "avg_qual", "q1", "q2", "q3"}
    return df.select(
        *[F.round(F.col(c), 6).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def sequence_stats(spark, sf_dir):
    reads = view(spark, sf_dir, "fx_seq")
    return _rounded(st.sequence_stats(reads, "source", "seq", "qual"))


def n50_by_sample(spark, sf_dir):
    return st.n50_by_sample(view(spark, sf_dir, "fx_seq"), "source")


def run_rollup(spark, sf_dir):
    return _rounded(st.run_rollup(view(spark, sf_dir, "fx_seq"), "source"))


def fasta_index(spark, sf_dir):
    records = view(spark, sf_dir, "fx_seq").withColumn(
        "name", F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(" read"))
    )
    return st.rendered_fasta_index(records, "source", "doc_id", "name", "seq", 80)


QUERIES = {
    f.__name__: f
    for f in (
        read_counts_by_sample,
        qc_long_metrics,
        demux_recovery,
        length_histogram_log10,
        observed_levels,
        length_filtered_reads,
        eligible_reads,
        sequence_stats,
        n50_by_sample,
        run_rollup,
        fasta_index,
    )
}

_LEVEL_ROWS = ",".join(f"('{s}',{i})" for i, s in enumerate(LEVELS, 1))
_KEPT = (
    f"kept as (select * from fx_summary where {LENGTH} is not null and {LENGTH}>={LOW} "
    f"and {LENGTH}<={HIGH})"
)
_COUNTED = (
    f"with lv(sample,level_no) as (values {_LEVEL_ROWS}), {_KEPT}, "
    'counts as (select lv.sample, cast(lv.level_no as integer) as level_no, '
    'cast(coalesce(c.n,0) as bigint) as "Freq" from lv left join '
    "(select alias, count(*) as n from kept group by alias) as c on c.alias=lv.sample) "
)
_RAW = (
    "(select count(*) from fx_summary where alias is not null) as n_reads_raw, "
    "(select count(*) from kept where alias is not null) as n_reads_filtered"
)

_FREQ_STATS = """
select {key}, {extra} count(*) as num_seqs, cast(sum(len) as bigint) as sum_len,
  cast(min(len) as bigint) as min_len, round(sum(len)*1.0/count(*),6) as avg_len,
  cast(max(len) as bigint) as max_len, cast(0 as bigint) as sum_gap,
  cast(max(case when down*2>=total then len end) as bigint) as n50,
  round(100.0*sum(gc)/sum(len),6) as gc_pct, round(100.0*sum(q20)/sum(len),6) as q20_pct,
  round(100.0*sum(q30)/sum(len),6) as q30_pct,
  round(-10*log10(sum(err)/sum(len)),6) as avg_qual,
  round(quantile_cont(len,0.25),6) as q1, round(quantile_cont(len,0.5),6) as q2,
  round(quantile_cont(len,0.75),6) as q3
from ranked group by {group}
"""
_PER_READ = """
per_read as (select source, length(seq) as len,
  length(seq)-length(translate(seq,'GC','')) as gc,
  length(regexp_replace(qual,'[^5-~]','','g')) as q20,
  length(regexp_replace(qual,'[^?-~]','','g')) as q30,
  coalesce(list_sum(list_transform(string_split(qual,''),
    lambda c: pow(10,-(ascii(c)-33)/10.0))),0) as err
  from fx_seq)
"""

ORACLES = {
    "read_counts_by_sample": _COUNTED + "select * from counts",
    "qc_long_metrics": _COUNTED
    + """select sample, level_no, 'Freq' as type, cast("Freq" as double) as value from counts
    union all select sample, level_no, 'Log10Freq',
      round(case when "Freq">0 then log10("Freq") end,9) from counts
    union all select sample, level_no, 'Recovered',
      case when sample='unclassified' then 0.0 else cast("Freq" as double) end from counts""",
    "demux_recovery": _COUNTED
    + f"""select round(case when sum("Freq")>0 then
      (1-sum(case when sample='unclassified' then "Freq" else 0 end)/sum("Freq"))*100 end,9)
      as recovery, cast(sum("Freq") as bigint) as n_reads_in_levels, {_RAW} from counts""",
    "length_histogram_log10": f"""with lv(sample,level_no) as (values {_LEVEL_ROWS}), {_KEPT},
      x as (select alias, log10({LENGTH}) as x from kept where alias is not null and {LENGTH}>0),
      b as (select alias, min(x) as lo, max(x) as hi from x group by alias),
      w as (select *, case when hi>lo then (hi-lo)/29 else 0.1 end as w from b),
      h as (select x.alias, cast(least(greatest(ceil((x.x-(w.lo-w.w/2))/w.w),1),30) as integer)
        as bin, count(*) as n from x join w on x.alias=w.alias group by 1,2)
      select lv.sample, cast(lv.level_no as integer) as level_no, h.bin,
        cast(coalesce(h.n,0) as bigint) as n from lv left join h on h.alias=lv.sample""",
    "observed_levels": f"""with {_KEPT} select alias as sample,
      cast(row_number() over (order by min(read_id)) as integer) as level_no
      from kept where alias is not null group by alias""",
    "length_filtered_reads": f"with {_KEPT} select * from kept",
    "eligible_reads": f"""with {_PER_READ.replace('select source,', 'select doc_id, source,')},
      ok as (select doc_id, source, cast(len as integer) as length,
        round(-10*log10(err/len),6) as mean_quality,
        -10*log10(err/len) as mq from per_read where len>0),
      passed as (select *, count(*) over (partition by source) as n from ok
        where length between 1000 and 3300 and mq>=8)
      select doc_id, source, length, mean_quality from passed where n>=16""",
    "sequence_stats": f"""with {_PER_READ}, ranked as (select *,
      sum(len) over (partition by source) as total,
      sum(len) over (partition by source order by len desc) as down from per_read)
      """
    + _FREQ_STATS.format(
        key="source", extra="'FASTQ' as format, 'DNA' as type,", group="source"
    ),
    "n50_by_sample": """with ranked as (select source, length(seq) as len,
      sum(length(seq)) over (partition by source) as total,
      sum(length(seq)) over (partition by source order by length(seq) desc) as down from fx_seq)
      select source, count(*) as num_seqs, cast(sum(len) as bigint) as sum_len,
      cast(max(case when down*2>=total then len end) as bigint) as n50
      from ranked group by source""",
    "run_rollup": f"""with {_PER_READ}, both_levels as (select *, 0 as is_total from per_read
        union all select null as source, len, gc, q20, q30, err, 1 as is_total from per_read),
      ranked as (select *, sum(len) over (partition by source, is_total) as total,
      sum(len) over (partition by source, is_total order by len desc) as down from both_levels)
      """
    + _FREQ_STATS.format(
        key="source",
        extra="cast(is_total as integer) as is_total,",
        group="source, is_total",
    ),
    "fasta_index": """with r as (select source, doc_id, concat('d',doc_id) as name,
        length(seq) as len, length(concat('d',doc_id,' read'))+2 as head from fx_seq),
      s as (select *, coalesce(sum(head+len+greatest(ceil(len/80.0),1)) over (partition by source
        order by doc_id rows between unbounded preceding and 1 preceding),0) as start from r)
      select source, doc_id as record_no, name, cast(len as bigint) as length,
        cast(start+head as bigint) as "offset", cast(least(len,80) as bigint) as line_bases,
        cast(case when len>0 then least(len,80)+1 else 0 end as bigint) as line_bytes from s""",
}
