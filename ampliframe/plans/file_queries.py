"""Layout, inventory, manifest and listing queries with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampliframe.functions.labels import safe_output_label
from ampliframe.operators import consensus as cons
from ampliframe.operators import delivery, demux
from ampliframe.operators import layout as lay
from ampliframe.plans.fixtures import safe_part, view
from ampliframe.sources.fasta import fasta_record, record_name, record_seq
from ampliframe.sources.files import list_directories
from ampliframe.sources.tables import coerce_summary

ROOT = "/data/fastq"


def layout_plan(spark, sf_dir):
    files = view(spark, sf_dir, "fx_layout_files")
    return lay.layout_plan(
        view(spark, sf_dir, "fx_sample_info"), ROOT, list_directories(files), "Project"
    )


def layout_dropped_rows(spark, sf_dir):
    rows = lay.layout_rows(view(spark, sf_dir, "fx_sample_info"), "Project")
    return rows.agg(
        F.count_if("valid").alias("kept"), F.count_if(~F.col("valid")).alias("dropped")
    )


def deliverable_inventory(spark, sf_dir):
    return delivery.deliverable_inventory(
        view(spark, sf_dir, "fx_runs"), view(spark, sf_dir, "fx_run_files")
    )


def ordered_inventory(spark, sf_dir):
    items = delivery.ordered_inventory(deliverable_inventory(spark, sf_dir))
    return items.select("result_dir", "item_no", "label", "source")


def delivery_manifest(spark, sf_dir):
    return delivery.delivery_manifest(view(spark, sf_dir, "fx_evidence"))


def evidence_problems(spark, sf_dir):
    return delivery.evidence_problems(
        view(spark, sf_dir, "fx_evidence"), view(spark, sf_dir, "fx_evidence_files")
    )


def missing_index(spark, sf_dir):
    return delivery.missing_indexes(view(spark, sf_dir, "fx_index_files"))


def duplicate_basenames(spark, sf_dir):
    return delivery.duplicate_basenames(view(spark, sf_dir, "fx_demux_files"))


def demux_tree(spark, sf_dir):
    return demux.demux_tree(view(spark, sf_dir, "fx_demux_files"))


def run_dirs(spark, sf_dir):
    return demux.run_directories(view(spark, sf_dir, "fx_demux_files"))


def fastq_samples(spark, sf_dir):
    return demux.fastq_samples(view(spark, sf_dir, "fx_demux_files"))


def directories(spark, sf_dir):
    return list_directories(view(spark, sf_dir, "fx_demux_files"))


def basecall_model(spark, sf_dir):
    return demux.basecall_models(view(spark, sf_dir, "fx_header_lines"))


def summary_coercion(spark, sf_dir):
    """Types of a summary read as text."""
    return coerce_summary(view(spark, sf_dir, "fx_summary_text"))


def fasta_records(spark, sf_dir):
    """Names and sequences of records as they stand in a file."""
    records = view(spark, sf_dir, "fx_records")
    return records.select(
        "doc_id", record_name("record").alias("name"), record_seq("record").alias("seq")
    )


def unnamed_records(spark, sf_dir):
    return cons.unnamed_records(view(spark, sf_dir, "fx_unnamed"))


def output_labels(spark, sf_dir):
    sheet = view(spark, sf_dir, "fx_sample_info")
    return sheet.select("p_partkey", safe_output_label("Project").alias("label"))


def checksums(spark, sf_dir):
    return view(spark, sf_dir, "fx_seq").select(
        F.md5("seq").alias("md5"),
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("path"),
    )


def fasta_lines(spark, sf_dir):
    named = view(spark, sf_dir, "fx_seq").withColumn(
        "name", F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    )
    return named.select("doc_id", fasta_record(width=80).alias("record"))


QUERIES = {
    f.__name__: f
    for f in (
        summary_coercion,
        fasta_records,
        unnamed_records,
        layout_plan,
        layout_dropped_rows,
        deliverable_inventory,
        ordered_inventory,
        delivery_manifest,
        evidence_problems,
        missing_index,
        duplicate_basenames,
        demux_tree,
        run_dirs,
        fastq_samples,
        directories,
        basecall_model,
        output_labels,
        checksums,
        fasta_lines,
    )
}

# list of the folders above each path, longest last
_ANCESTORS = (
    "select distinct dir from (select unnest(list_transform(range(2,len(p)), "
    "lambda k: array_to_string(p[1:k],'/'))) as dir from "
    "(select string_split(path,'/') as p from {0})) where dir<>''"
)
_GROUP = (
    f"concat({safe_part('Project')},'_',{safe_part('Expected_Amplicon_Size_bp')})"
).replace("<G>", ",'g'")
_BARCODE = "concat('barcode',regexp_replace(Barcode_ID,'.+-([0-9]+$)','\\1'))"
_BASENAME = "regexp_extract({0},'[^/]*$')"

_ROLE_ROWS = ",".join(
    f"('{r}','{label}','{place}')" for r, label, place in delivery.DELIVERY_ROLES
)

ORACLES = {
    "layout_plan": f"""with dirs as ({_ANCESTORS.format('fx_layout_files')}),
      p as (select {_BARCODE} as barcode, Project as project,
        Expected_Amplicon_Size_bp as amplicon_size, {_GROUP} as "group" from fx_sample_info
        where Project is not null and Project<>''),
      q as (select *, concat('{ROOT}/',barcode) as source,
        concat('{ROOT}/',"group",'/',barcode) as destination from p)
      select q.*, source in (select dir from dirs) as source_exists,
        destination in (select dir from dirs) as destination_exists, false as moved,
        case when source in (select dir from dirs) then 'planned' else 'missing_source' end
        as status from q""",
    "layout_dropped_rows": """select count(*) filter (where Project is not null and Project<>'')
      as kept, count(*) filter (where Project is null or Project='') as dropped
      from fx_sample_info""",
    "deliverable_inventory": f"""with f as (select distinct path from fx_run_files),
      d as ({_ANCESTORS.format('fx_run_files')}),
      bd as (select dir, regexp_replace(dir,'/[^/]*$','') as result_dir,
        {_BASENAME.format('dir')} as bc from d),
      b as (select bd.dir, bd.bc, r.* from bd join fx_runs as r on r.result_dir=bd.result_dir
        where regexp_matches(bd.bc,'^barcode[0-9]+$')),
      fixed as (
        select result_dir, 'untrimmed_consensus' as label,
          concat(result_dir,'/all-consensus-seqs.fasta') as source,
          concat(output_dir,'/all-consensus-seqs.fasta') as destination from fx_runs
        union all select result_dir, 'consensus_fasta_index',
          concat(result_dir,'/all-consensus-seqs.fasta.fai'),
          concat(output_dir,'/all-consensus-seqs.fasta.fai') from fx_runs
        union all select result_dir, 'trimmed_consensus',
          concat(result_dir,'/all-consensus-seqs_trimmed.fasta'),
          concat(output_dir,'/all-consensus-seqs_trimmed.fasta') from fx_runs
        union all select result_dir, 'sample_map', sample_map,
          concat(output_dir,'/',{_BASENAME.format('sample_map')}) from fx_runs
          where sample_map is not null)
      select *, 'file' as type, source in (select path from f) as "exists" from fixed
      union all select result_dir, bc, dir, concat(output_dir,'/',bc), 'directory', true from b
      union all select b.result_dir, concat(b.bc,'_read_length_plot'), f.path,
        concat(b.output_dir,'/',b.bc,'/',{_BASENAME.format('f.path')}), 'file', true
        from b join f on regexp_replace(f.path,'/[^/]*$','')=concat(b.fastq_pass_trim_dir,'/',b.bc)
        where regexp_matches({_BASENAME.format('f.path')},'^Distribution_seqLength__.*[.]png$')
      union all select result_dir, 'execution', concat(result_dir,'/execution'),
        concat(output_dir,'/execution'), 'directory',
        concat(result_dir,'/execution') in (select dir from d) from fx_runs
        where include_execution
      union all select result_dir, 'README', null, concat(output_dir,'/README.txt'), 'file', true
        from fx_runs""",
    "delivery_manifest": f"""with roles(role,label,place) as (values {_ROLE_ROWS})
      select e.project, r.label, e.source, case when right(r.place,1)='/' then
        concat(r.place,{_BASENAME.format('e.source')}) else r.place end as delivery_path
      from fx_evidence as e join roles as r on r.role=e.role
      union all select distinct project, 'consensus_fasta_index',
        'generated by samtools faidx', '01_consensus/consensus.fasta.fai' from fx_evidence
        where role='consensus'
      union all select distinct project, 'consensus_stats',
        'generated by seqkit stats -a -T', '03_qc/consensus_stats.tsv' from fx_evidence
        where role='consensus'""",
    "evidence_problems": """select e.project, e.role, e.source,
      case when f.size is null then 'missing' else 'empty' end as problem
      from fx_evidence as e left join (select path, min(size) as size from fx_evidence_files
        group by path) as f on f.path=e.source
      where f.size is null or f.size<=0""",
    "missing_index": """select path, 'fasta' as kind from fx_index_files where path like '%.fasta'
      and concat(path,'.fai') not in (select path from fx_index_files)
      union all select path, 'bam' from fx_index_files where path like '%.bam'
      and concat(path,'.bai') not in (select path from fx_index_files)
      and concat(left(path,length(path)-4),'.bai') not in (select path from fx_index_files)""",
    "duplicate_basenames": f"""select {_BASENAME.format('path')} as name, count(*) as n_files
      from fx_demux_files group by 1 having count(*)>1""",
    "demux_tree": """with d as (select distinct regexp_replace(path,'/[^/]*$','') as bam_dir
        from fx_demux_files where path like '%.bam'),
      p as (select bam_dir, string_split(bam_dir,'/') as parts from d),
      r as (select bam_dir, parts, unnest(range(2,len(parts))) as k from p)
      select array_to_string(parts[1:k-1],'/') as run_dir,
        array_to_string(parts[k+1:],'/') as rel_path, bam_dir,
        concat(array_to_string(parts[1:k-1],'/'),'/fastq_pass_trim/',
          array_to_string(parts[k+1:],'/'),'/',parts[-1],'.fastq.gz') as output
      from r where parts[k]='bam_pass'""",
    "run_dirs": """with p as (select distinct
        string_split(regexp_replace(path,'/[^/]*$',''),'/') as parts from fx_demux_files),
      r as (select parts, unnest(range(2,len(parts)+1)) as k from p)
      select distinct array_to_string(parts[1:k-1],'/') as run_dir from r
      where parts[k]='bam_pass'""",
    "fastq_samples": """select path, regexp_replace(regexp_replace(regexp_replace(
        regexp_extract(path,'[^/]*$'),'[.]gz$',''),'[.]fastq$',''),'[.]fq$','') as sample
      from fx_demux_files where regexp_matches(path,'[.](fastq|fq)([.]gz)?$')""",
    "directories": _ANCESTORS.format("fx_demux_files"),
    "basecall_model": """with t as (select file, line_no,
        string_split(regexp_extract(line,' DS:(.*)$',1),' ') as words from fx_header_lines
        where line like '@RG%' and line like '% DS:%'),
      w as (select file, line_no, list_filter(words, lambda x: x like 'basecall_model=%')[1] as m
        from t)
      select file, substr(arg_min(m,line_no),16) as model from w where m is not null
      group by file""",
    "summary_coercion": """select read_id, alias, try_cast(sequence_length_template as double)
      as sequence_length_template from fx_summary_text""",
    "fasta_records": """select doc_id, concat('d',doc_id,' note') as name, seq from fx_seq""",
    "unnamed_records": """select record_no, case when coalesce(name,'')='' then 'no name'
      else 'no sequence' end as problem from fx_unnamed where coalesce(name,'')='' or seq=''""",
    "output_labels": """select p_partkey, regexp_replace(Project,'[^A-Za-z0-9_.-]+','_','g')
      as label from fx_sample_info""",
    "checksums": """select md5(seq) as md5, concat(source,'/',doc_id) as path from fx_seq""",
    "fasta_lines": """select doc_id, concat('>d',doc_id,chr(10),case when seq='' then '' else
      array_to_string(list_transform(range(0,cast(ceil(length(seq)/80.0) as bigint)),
        lambda i: substr(seq,i*80+1,80)),chr(10)) end) as record from fx_seq""",
}

ORACLES["ordered_inventory"] = f"""select result_dir, label, source,
  cast(row_number() over (partition by result_dir order by case label
    when 'untrimmed_consensus' then 0 when 'consensus_fasta_index' then 1
    when 'trimmed_consensus' then 2 when 'sample_map' then 3 when 'execution' then 5
    when 'README' then 6 else 4 end, regexp_replace(label,'_read_length_plot$',''),
    case when type='directory' then 0 else 1 end, source) as integer) as item_no
  from ({ORACLES['deliverable_inventory']}) as items"""
