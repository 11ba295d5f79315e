"""Queries over stored reads, primer panels and several references, with the SQL that checks them.

Reads and records derived from the given tables are written to a folder of their own below the
shared checkpoint folder and read back from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliframe.operators import demux, primer_panel, references
from ampliframe.plans.fixtures import rc, view
from ampliframe.plans.sequence_queries import affine_steps
from ampliframe.session import ensure_checkpoint_dir
from ampliframe.sources import fasta, fasta_pieces, fastq, files
from ampliframe.sources.tables import read_sample_info

#: small, so that files of the given tables fall into many ranges
SPLIT_BYTES = 1 << 18
LEAST_LENGTH, LEAST_QUALITY = 600, 7.0
K, WINDOW = 11, 5


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _source(file: str = "file"):
    """The source that a folder is named by; '+' stands for itself there."""
    named = F.regexp_extract(file, "source=([^/]*)", 1)
    value = F.url_decode(F.replace(named, F.lit("+"), F.lit("%2B")))
    return F.when(named == fastq.NO_VALUE, "").otherwise(value).alias("source")


def _stored_reads(spark, sf_dir) -> str:
    folder = _folder(spark, "reads")
    reads = view(spark, sf_dir, "fx_fastq").drop("doc_id")
    fastq.write_reads_by(reads, folder, by=["source"], file_bytes=8 << 20)
    return folder


def stored_reads(spark, sf_dir) -> DataFrame:
    """Reads written as blocked gzip by source, and read back by ranges."""
    found = fastq.read_fastq(spark, _stored_reads(spark, sf_dir), SPLIT_BYTES)
    return found.select(
        _source(), "name", F.length("seq").alias("length"), F.md5("seq").alias("seq_md5"),
        F.md5("qual").alias("qual_md5"),
    )


def stored_read_numbers(spark, sf_dir) -> DataFrame:
    """By source: reads, distinct record numbers of all files, and the sum of the last ones."""
    found = fastq.read_fastq(spark, _stored_reads(spark, sf_dir), SPLIT_BYTES)
    files = found.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("record_no").alias("numbers"),
        F.max("record_no").alias("last"),
    )
    return files.groupBy(_source()).agg(*[F.sum(c).alias(c) for c in ("n", "numbers", "last")])


def selected_reads(spark, sf_dir) -> DataFrame:
    """Long reads of good quality; both filters are taken over by the scan."""
    columns = ("name", "length", "mean_quality")
    found = fastq.scan_fastq(spark, _stored_reads(spark, sf_dir), SPLIT_BYTES, columns)
    kept = found.filter((F.col("length") >= LEAST_LENGTH) & (F.col("mean_quality") > LEAST_QUALITY))
    rows = kept.select("name", "length", F.round("mean_quality", 6).alias("mean_quality"))
    # the scan's value may stand the last bits above a limit that the rounded one only reaches
    return rows.filter(F.col("mean_quality") > LEAST_QUALITY)


def gzip_block_totals(spark, sf_dir) -> DataFrame:
    """Data bytes of all blocks by source, and how many blocks begin where the one before ends."""
    index = fastq.block_index(spark, _stored_reads(spark, sf_dir), SPLIT_BYTES)
    files = index.groupBy("file").agg(
        F.sum("data_bytes").alias("data_bytes"),
        (F.max(F.col("data_offset") + F.col("data_bytes")) == F.sum("data_bytes")).alias("closed"),
        (F.min("data_offset") == 0).alias("begins"),
    )
    return files.groupBy(_source()).agg(
        F.sum("data_bytes").alias("data_bytes"), F.bool_and(F.col("closed") & F.col("begins")).alias("placed")
    )


def stored_gzip_audit(spark, sf_dir) -> DataFrame:
    """Whether all files written for a source inflate to their end."""
    found = files.list_files(spark, _stored_reads(spark, sf_dir), "*.gz")
    audit = files.gzip_audit(found)
    return audit.groupBy(_source("path")).agg(F.bool_and("ok").alias("ok"))


def _stored_by(spark, sf_dir, name: str, by: str) -> str:
    folder = _folder(spark, "plain")
    rows = view(spark, sf_dir, name)
    rows = rows.select(F.col(by).alias("source"), "name", "seq", "qual")
    fastq.write_reads_by(rows, folder, by=["source"], compression="none")
    return folder


def stored_listing(spark, sf_dir) -> DataFrame:
    """Bytes of the files written for a source, and the folders they are in."""
    listed = files.list_entries(spark, _stored_by(spark, sf_dir, "fx_fastq", "source"))
    return listed.groupBy(_source("path")).agg(
        F.sum("size").alias("bytes"), F.count_if("is_dir").alias("folders")
    )


def stored_md5_list(spark, sf_dir) -> DataFrame:
    """Checksums of files with one read each."""
    folder = _stored_by(spark, sf_dir, "fx_supplier_reads", "name")
    sums = files.md5_list(files.list_entries(spark, folder).filter("not is_dir"), folder)
    return sums.select("md5", _source("path").alias("name"))


def stored_sample_sheet(spark, sf_dir) -> DataFrame:
    """A sample sheet written as CSV and read with its types."""
    folder = _folder(spark, "sheet")
    sheet = view(spark, sf_dir, "fx_sample_info").drop("Primer_Sequence_3")
    writer = sheet.write.option("header", True).option("nullValue", "NA")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return read_sample_info(spark, folder)


def tagged_basecall_models(spark, sf_dir) -> DataFrame:
    """Base-call models of descriptions that another tag follows."""
    return demux.basecall_models(view(spark, sf_dir, "fx_header_tags"))


def stored_fasta_index(spark, sf_dir) -> DataFrame:
    """Index rows of FASTA files as written; records longer than a range go through several."""
    folder = _folder(spark, "records")
    fasta.write_fasta(view(spark, sf_dir, "fx_fastq").select("name", "seq"), folder)
    rows = fasta_pieces.index_rows(spark, folder, SPLIT_BYTES)
    return rows.select("name", "length", "line_bases", "line_bytes")


def stored_fasta_chunks(spark, sf_dir) -> DataFrame:
    """Sequences put together again from chunks of a sixteenth of that size."""
    folder = _folder(spark, "records")
    fasta.write_fasta(view(spark, sf_dir, "fx_fastq").select("name", "seq"), folder)
    chunks = fasta_pieces.scan_fasta_chunks(spark, folder, SPLIT_BYTES)
    ordered = F.array_sort(F.collect_list(F.struct("start", "bases")))
    whole = chunks.groupBy("file", "record_no").agg(
        F.array_join(F.transform(ordered, lambda c: c["bases"]), "").alias("seq"),
        F.sum(F.length("bases")).alias("length"),
    )
    return whole.select("length", F.md5("seq").alias("seq_md5"))


def _panel_hits(spark, sf_dir, max_mismatch: int) -> DataFrame:
    pairs = view(spark, sf_dir, "fx_panel")
    return primer_panel.panel_hits(view(spark, sf_dir, "fx_panel_reads"), pairs, max_mismatch)


def primer_panel_exact(spark, sf_dir) -> DataFrame:
    """First starts of the primers of all pairs in all sequences, without mismatches."""
    found = _panel_hits(spark, sf_dir, 0)
    return found.select("doc_id", "pair_no", "f_start", "rc_r_start", "r_start", "rc_f_start")


def primer_panel_best(spark, sf_dir) -> DataFrame:
    """The pair of the panel that bounds the widest part of each sequence, two mismatches allowed."""
    best = primer_panel.best_pair(_panel_hits(spark, sf_dir, 2), ["doc_id"], ["pair_no"])
    return best.select("doc_id", "pair_no", "orientation", "start", "end")


def _votes(spark, sf_dir) -> DataFrame:
    reads = view(spark, sf_dir, "fx_group_reads").select("record_no", "seq")
    targets = view(spark, sf_dir, "fx_references")
    return references.shared_minimizers(targets, reads, ["record_no"], K, WINDOW)


def reference_votes(spark, sf_dir) -> DataFrame:
    """Minimizers that reads share with references."""
    return _votes(spark, sf_dir)


def read_references(spark, sf_dir) -> DataFrame:
    """The reference with most minimizers of each read."""
    return references.best_reference(_votes(spark, sf_dir), ["record_no"], 2)


def grouped_orientation(spark, sf_dir) -> DataFrame:
    """Strand of reads against the reference of their own group."""
    return references.orient_to_references(
        view(spark, sf_dir, "fx_references"), view(spark, sf_dir, "fx_group_reads")
    )


QUERIES = {
    f.__name__: f
    for f in (
        stored_reads,
        stored_read_numbers,
        selected_reads,
        gzip_block_totals,
        stored_gzip_audit,
        stored_listing,
        stored_md5_list,
        stored_sample_sheet,
        tagged_basecall_models,
        stored_fasta_index,
        stored_fasta_chunks,
        primer_panel_exact,
        primer_panel_best,
        reference_votes,
        read_references,
        grouped_orientation,
    )
}

# ---- checking SQL ---------------------------------------------------------------------------

_ERROR = "list_sum(list_transform(string_split(qual,''), lambda c: pow(10, -(ascii(c)-33)/10.0)))"
_KMER = f"substr(seq,i,{K})"
_MINIMIZED = f"""
  minimized as (select kind, id, unnest(list_distinct(case when len(ks)<{WINDOW} then
      [list_min(ks)] else list_transform(range(1,len(ks)-{WINDOW}+2),
      lambda i: list_min(ks[i:i+{WINDOW}-1])) end)) as m
    from (select kind, id, list_transform(range(1,length(seq)-{K}+2),
      lambda i: least({_KMER},{rc(_KMER)})) as ks from (
        select 'read' as kind, cast(record_no as varchar) as id, seq from fx_group_reads
        union all select 'reference', name, seq from fx_references) where length(seq)>={K})),
  votes as (select cast(r.id as bigint) as record_no, t.id as reference, count(*) as votes
    from minimized as r join minimized as t on r.m=t.m and r.kind='read' and t.kind='reference'
    group by 1, 2)"""

ORACLES = {
    "stored_reads": """select source, name, cast(length(seq) as integer) as length,
      md5(seq) as seq_md5, md5(qual) as qual_md5 from fx_fastq""",
    "stored_read_numbers": """select source, count(*) as n, count(*) as numbers,
      count(*) as last from fx_fastq group by source""",
    "selected_reads": f"""select name, length(seq) as length, mean_quality from (
      select name, seq, round(-10*log10({_ERROR}/length(qual)),6) as mean_quality from fx_fastq
      where length(seq)>={LEAST_LENGTH}) where mean_quality>{LEAST_QUALITY}""",
    "gzip_block_totals": """select source, sum(length(name)+2*length(seq)+6)::bigint as data_bytes,
      true as placed from fx_fastq group by source""",
    "stored_gzip_audit": "select distinct source, true as ok from fx_fastq",
    "stored_listing": """select source, sum(length(name)+2*length(seq)+6)::bigint as bytes,
      1::bigint as folders from fx_fastq group by source""",
    "stored_md5_list": """select md5(concat('@',name,chr(10),seq,chr(10),'+',chr(10),qual,chr(10)))
      as md5, name from fx_supplier_reads""",
    "stored_sample_sheet": """select p_partkey::integer as p_partkey, Barcode_ID, Project,
      Expected_Amplicon_Size_bp, Primer_Sequence_5 from fx_sample_info""",
    "tagged_basecall_models": """with d as (select file, line_no, list_filter(string_split(
        regexp_extract(line,' DS:(.*?)( [A-Z][A-Z]:|$)',1),' '),
        lambda w: w like 'basecall_model=%')[1] as m from fx_header_tags where line like '@RG%')
      select file, substr(arg_min(m,line_no),16) as model from d where m is not null
      group by file""",
    "stored_fasta_index": """select name, length(seq) as length, least(80,length(seq)) as line_bases,
      case when seq='' then 0 else least(80,length(seq))+1 end as line_bytes from fx_fastq""",
    "stored_fasta_chunks": "select length(seq) as length, md5(seq) as seq_md5 from fx_fastq",
    "primer_panel_exact": f"""with words as (
        select doc_id, i, substr(seq,i,20) as w from fx_panel_reads,
        unnest(range(1,length(seq)-18)) as u(i)),
      wanted as (
        select pair_no, 0 as role, f_primer as w from fx_panel
        union all select pair_no, 1, {rc('r_primer')} from fx_panel
        union all select pair_no, 2, r_primer from fx_panel
        union all select pair_no, 3, {rc('f_primer')} from fx_panel),
      met as (select doc_id, pair_no, role, cast(min(i) as integer) as place
        from words join wanted using (w) group by doc_id, pair_no, role)
      select doc_id, pair_no, max(place) filter (role=0) as f_start,
        max(place) filter (role=1) as rc_r_start, max(place) filter (role=2) as r_start,
        max(place) filter (role=3) as rc_f_start from met group by doc_id, pair_no""",
    "reference_votes": f"with {_MINIMIZED} select * from votes",
    "read_references": f"""with {_MINIMIZED} select record_no, reference, votes from votes
      where votes>=2 qualify row_number() over (partition by record_no
      order by votes desc, reference)=1""",
    "grouped_orientation": f"""with recursive
      named as (select r.*, t.seq as target from fx_group_reads as r
        join fx_references as t on t.name=r.reference),
      keys as (select row(s,t,false) as k, string_split(t,'') as a, string_split(s,'') as b
        from (select distinct seq as s, target as t from named)
        union all select row(s,t,true), string_split(t,''), string_split({rc('s')},'')
        from (select distinct seq as s, target as t from named)),
      dp(k,a,b,i,h,e,best) as (select k, a, b, cast(0 as bigint),
        list_transform(range(0,len(b)+1), lambda j: cast(0 as bigint)),
        list_transform(range(0,len(b)+1), lambda j: cast(-1000000000 as bigint)),
        cast(0 as bigint) from keys union all
      {affine_steps(2, -3, 5, 2, True)}),
      ends as (select k, best from dp where i=len(a)),
      scored as (select n.*, cast(f.best as double) as forward_score,
        cast(r.best as double) as reverse_score from named as n
        join ends as f on f.k=row(n.seq,n.target,false)
        join ends as r on r.k=row(n.seq,n.target,true))
      select record_no, reference, name as sample, case when reverse_score>forward_score then
        'reverse_complement' else 'forward' end as direction, forward_score, reverse_score,
        greatest(forward_score,reverse_score) as selected_score,
        abs(forward_score-reverse_score) as score_delta,
        case when reverse_score>forward_score then {rc('seq')} else seq end as oriented_seq
      from scored""",
}
