"""Amplicon data derived from the given tables, as SQL for Spark and for the checking engine.

Every view keeps whole rows and whole texts. `<S>` is the text type and `<G>` the flag that makes
regexp_replace global.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ampliframe.functions.labels import OUTER_SPACE, SAFE_PATH_STEPS

F_PRIMER = "AGAGTTTGATCMTGGCTCAG"
R_PRIMER = "TACGGYTACCTTGTTACGACTT"

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_AS_DNA = "ACGTACGTACGTACGTACGTACGTAC"
_AS_QUALITY = "#$%&()*+,-./0123456789:;<="
_RC = "reverse(translate({0},'ACGTMRWSYKVHDBN','TGCAKYWSRMBDHVN'))"


def rc(expression: str) -> str:
    return _RC.format(expression)


def _hex_dna(expression: str) -> str:
    return f"translate(md5({expression}),'0123456789abcdef','ACGTACGTACGTACGT')"


def _letters(column: str) -> str:
    return f"upper(regexp_replace({column},'[^A-Za-z]',''<G>))"


def safe_part(expression: str) -> str:
    """SQL of the path-safe key; backslashes are doubled for Spark by `view_sql`."""
    text = f"regexp_replace({expression},'{OUTER_SPACE}',''<G>)"
    for pattern, new in SAFE_PATH_STEPS:
        text = f"regexp_replace({text},'{pattern}','{new}'<G>)"
    return text


_FORWARD_END = (
    "case when doc_id % 3=0 then 'AGAGTTTGATCATGGCTCAG' else 'AGAGTCTGATCATGGCTCAG' end"
)
_AMPLICON = (
    f"concat('AA',{_FORWARD_END},seq,{rc(chr(39) + 'TACGGTTACCTTGTTACGACTT' + chr(39))},'TT')"
)


def _edited(seq: str, key: str) -> str:
    """Same, one base lost, turned with one substitution, or turned with two bases more."""
    return (
        f"case {key} % 4 when 0 then {seq} "
        f"when 1 then concat(substr({seq},1,10),substr({seq},12)) "
        f"when 2 then {rc(f'concat(substr({seq},1,19),{chr(39)}A{chr(39)},substr({seq},21))')} "
        f"else {rc(f'concat(substr({seq},1,20),{chr(39)}GT{chr(39)},substr({seq},21))')} end"
    )


def _moved_name(key: str) -> str:
    return (
        f"concat('c',cast(case when {key} % 5=0 then {key}+1000000000 else {key} end as <S>))"
    )


_CUSTOMER = "concat('{0}',cast(c_custkey as <S>))"
_PANELLED = f"concat('AC',f_primer,seq,{rc('r_primer')},'GT')"
_REFERENCE = (
    f"concat({_hex_dna('{0}')},{_hex_dna(chr(39) + 'all' + chr(39))},"
    f"{_hex_dna('reverse({0})')})"
)
_PART_SEQ = _hex_dna("concat_ws('|',p_name,p_brand,p_type,cast(p_partkey as <S>))")
_BARCODE_NO = "lpad(cast({0} as <S>),2,'0')"

VIEWS: dict[str, str] = {
    "fx_summary": (
        "select l_orderkey*10+l_linenumber as read_id, case when l_suppkey % 13 = 0 then "
        "'unclassified' when l_suppkey % 13 = 12 then cast(null as <S>) else "
        "concat('barcode',lpad(cast(l_suppkey % 13 as <S>),2,'0')) end as alias, "
        "case when l_partkey % 50 = 0 then cast(null as double) else "
        "floor(l_extendedprice/10)*1.0 end as sequence_length_template from lineitem"
    ),
    # the same kind of table as a text file gives it: blanks, missing fields and bad numbers
    "fx_summary_text": (
        "select l_orderkey*10+l_linenumber as read_id, case when l_suppkey % 13 = 11 then '' "
        "when l_suppkey % 13 = 12 then cast(null as <S>) else concat('barcode',cast(l_suppkey % 13 "
        "as <S>)) end as alias, case l_partkey % 7 when 0 then 'about 900' when 1 then '' "
        "when 2 then cast(null as <S>) when 3 then '1e3' when 4 then '-12.5' else "
        "cast(cast(floor(l_extendedprice) as bigint) as <S>) end as sequence_length_template "
        "from lineitem"
    ),
    "fx_seq": (
        f"select doc_id, source, translate({_letters('text')},'{_LETTERS}','{_AS_DNA}') as seq, "
        f"translate({_letters('text')},'{_LETTERS}','{_AS_QUALITY}') as qual from documents"
    ),
    "fx_fastq": (
        "select doc_id, coalesce(source,'none') as source, concat('d',cast(doc_id as <S>)) as "
        "name, coalesce(seq,'') as seq, coalesce(qual,'') as qual from fx_seq"
    ),
    # records of a sequence file, some lines ended the other way
    "fx_records": (
        "select doc_id, concat('>d',cast(doc_id as <S>),' note',case when doc_id % 3=0 then "
        "chr(13) else '' end,chr(10),substr(seq,1,60),chr(13),chr(10),substr(seq,61)) as record "
        "from fx_seq"
    ),
    "fx_unnamed": (
        "select record_no, case when record_no % 5=0 then '' when record_no % 7=0 then "
        "cast(null as <S>) else name end as name, case when record_no % 11=0 then '' else seq end "
        "as seq from fx_cons1"
    ),
    # the same bases in lower case with the white space of the text
    "fx_raw_seq": (
        "select doc_id, translate(upper(regexp_replace(text,'[^A-Za-z \\t\\r\\n]',''<G>)),"
        f"'{_LETTERS}','{_AS_DNA.lower()}') as seq from documents"
    ),
    # part sequences; every name comes a second time, later and with another sequence
    "fx_cons1": (
        f"select concat('c',cast(p_partkey as <S>)) as name, p_partkey as record_no, "
        f"{_PART_SEQ} as seq from part union all "
        f"select concat('c',cast(p_partkey as <S>)) as name, p_partkey+1000000000 as record_no, "
        f"reverse({_PART_SEQ}) as seq from part"
    ),
    "fx_cons2": (
        f"select {_moved_name('p_partkey')} as name, p_partkey as record_no, "
        f"{_edited('seq', 'p_partkey')} as seq from (select p_partkey, {_PART_SEQ} as seq "
        "from part) as t"
    ),
    # repeats and unknown names occur in the map
    "fx_map": (
        "select concat('c',cast(l_partkey as <S>)) as seq1_name, "
        "concat('c',cast(case when l_suppkey % 3=0 then l_partkey+1000000000 else l_partkey end "
        "as <S>)) as seq2_name, l_orderkey*10+l_linenumber as pair_no from lineitem"
    ),
    # texts without a letter are empty sequences
    "fx_bases": "select doc_id, coalesce(seq,'') as seq from fx_seq",
    "fx_doc1": (
        "select concat('c',cast(doc_id as <S>)) as name, doc_id as record_no, seq "
        "from fx_bases"
    ),
    "fx_doc2": (
        f"select {_moved_name('doc_id')} as name, doc_id as record_no, "
        f"{_edited('seq', 'doc_id')} as seq from fx_bases"
    ),
    "fx_amplicon": (
        f"select doc_id, source, case when doc_id % 7=0 then seq when doc_id % 2=1 then "
        f"{rc(_AMPLICON)} else {_AMPLICON} end as seq from fx_seq"
    ),
    "fx_reference": (
        f"select string_agg({_hex_dna('r_name')},'' order by r_regionkey) as seq from region"
    ),
    # reads of a customer: the piece of its region with the customer's own bases in the middle
    "fx_reads": (
        "select c_custkey as record_no, case when c_custkey % 6=0 then '' else c_name end "
        "as name, case when c_custkey % 2=0 then piece else "
        f"{rc('piece')} end as seq from (select c_custkey, c_name, "
        f"concat(substr({_hex_dna('r_name')},1,16), "
        "translate(cast(c_custkey as <S>),'0123456789','ACGTACGTAC'), "
        f"substr({_hex_dna('r_name')},17)) as piece from customer join nation on "
        "c_nationkey=n_nationkey join region on n_regionkey=r_regionkey) as t"
    ),
    # a primer pair for every customer, and documents between the primers of one of them
    "fx_panel": (
        "select c_custkey as pair_no, "
        f"substr({_hex_dna(_CUSTOMER.format('f'))},1,20) as f_primer, "
        f"substr({_hex_dna(_CUSTOMER.format('r'))},1,20) as r_primer from customer"
    ),
    "fx_panel_reads": (
        f"select doc_id, case when doc_id % 7=0 then seq when doc_id % 2=1 then {rc(_PANELLED)} "
        f"else {_PANELLED} end as seq from (select doc_id, coalesce(seq,'') as seq, f_primer, "
        "r_primer from fx_seq join fx_panel on pair_no=doc_id % 150+1) as t"
    ),
    # references of regions with a stretch in common, and reads of customers that reach into it
    "fx_references": (
        f"select r_name as name, {_REFERENCE.format('r_name')} as seq from region"
    ),
    "fx_group_reads": (
        "select c_custkey as record_no, c_name as name, r_name as reference, "
        f"case when c_custkey % 2=0 then piece else {rc('piece')} end as seq from (select "
        f"c_custkey, c_name, r_name, concat(substr({_REFERENCE.format('r_name')},"
        "c_custkey % 20+1,24),translate(cast(c_custkey as <S>),'0123456789','ACGTACGTAC'),"
        f"substr({_REFERENCE.format('r_name')},c_custkey % 20+25,30)) as piece from customer "
        "join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey) as t"
    ),
    "fx_sample_info": (
        "select p_partkey, concat('NB-',lpad(cast(p_partkey % 96+1 as <S>),2,'0')) as Barcode_ID, "
        "case when p_partkey % 41=0 then cast(null as <S>) else concat(' ',p_brand,' / ',p_type,"
        "' ') end as Project, concat(cast((p_size % 4+1)*800 as <S>),'bp') as "
        "Expected_Amplicon_Size_bp, case when p_partkey % 29=0 then '' else "
        f"lower(concat(translate({_letters('p_brand')},'{_LETTERS}','{_AS_DNA}'),"
        f"translate({_letters('p_type')},'{_LETTERS}','{_AS_DNA}'))) end as Primer_Sequence_5, "
        + rc(f"translate({_letters('p_type')},'{_LETTERS}','{_AS_DNA}')")
        + " as Primer_Sequence_3 from part"
    ),
    # one read folder per supplier class, and some folders already at their destination
    "fx_layout_files": (
        "select concat('/data/fastq/barcode',lpad(cast(l_suppkey % 89+1 as <S>),2,'0'),'/r',"
        "cast(l_orderkey as <S>),'.fastq.gz') as path from lineitem union all "
        "select concat(case when p_partkey % 17=0 then '/data/fastq/' else '/data/elsewhere/' "
        "end,"
        + safe_part("coalesce(Project,'none')")
        + ",'_',"
        + safe_part("Expected_Amplicon_Size_bp")
        + ",'/barcode',lpad(cast(p_partkey % 96+1 as <S>),2,'0'),'/r.fastq.gz') as path "
        "from fx_sample_info"
    ),
    "fx_runs": (
        "select concat('/runs/run',cast(c_custkey as <S>)) as result_dir, "
        "concat('/out/run',cast(c_custkey as <S>)) as output_dir, "
        "case when c_custkey % 3=0 then concat('/maps/run',cast(c_custkey as <S>),'.tsv') end "
        "as sample_map, case when c_custkey % 2=0 then "
        "concat('/trim/run',cast(c_custkey as <S>)) end as fastq_pass_trim_dir, "
        "c_custkey % 5=0 as include_execution from customer"
    ),
    "fx_run_files": (
        "select case kind when 0 then concat(run,'/all-consensus-seqs.fasta') "
        "when 1 then concat(run,'/all-consensus-seqs.fasta.fai') "
        "when 2 then concat(run,'/all-consensus-seqs_trimmed.fasta') "
        "when 3 then concat(run,'/barcode',bc,'/alignments/x.bam') "
        "when 4 then concat(run,'/execution/trace.txt') "
        "when 5 then concat('/trim/run',k,'/barcode',bc,'/Distribution_seqLength__sup__barcode',"
        "bc,'.png') when 6 then concat('/maps/run',k,'.tsv') "
        "else concat(run,'/workflow-report.html') end as path from (select "
        "o_orderkey % 8 as kind, concat('/runs/run',cast(o_custkey as <S>)) as run, "
        "cast(o_custkey as <S>) as k, case o_orderkey % 3 when 0 then '01' when 1 then '02' "
        "else '57' end as bc from orders) as t"
    ),
    "fx_evidence": (
        "select concat('P',cast(l_orderkey as <S>)) as project, case l_linenumber "
        "when 1 then 'consensus' when 2 then 'sample_sheet' when 3 then 'bam' when 4 then 'bai' "
        "when 5 then 'variants_af' when 6 then 'notes' else 'flye_log' end as role, "
        "concat('/in/P',cast(l_orderkey as <S>),'/file',cast(l_linenumber as <S>),'.dat') "
        "as source from lineitem"
    ),
    "fx_evidence_files": (
        "select concat(case when l_suppkey % 31=0 then '/lost/P' else '/in/P' end,"
        "cast(l_orderkey as <S>),'/file',cast(l_linenumber as <S>),'.dat') "
        "as path, cast(case when l_partkey % 50=0 then 0 else floor(l_extendedprice) end as "
        "bigint) as size from lineitem"
    ),
    "fx_index_files": (
        "select concat('/ref/g',cast(o_orderkey as <S>),'.fasta') as path from orders union all "
        "select concat('/ref/g',cast(o_orderkey as <S>),case when o_custkey % 3=0 then "
        "'.fasta.old' else '.fasta.fai' end) as path from orders union all "
        "select concat('/aln/a',cast(o_orderkey as <S>),'.bam') as path from orders union all "
        "select concat('/aln/a',cast(o_orderkey as <S>),case when o_custkey % 5=0 then '.csi' "
        "when o_custkey % 2=0 then '.bam.bai' else '.bai' end) as path from orders"
    ),
    # amplicons between the primers of their own sheet row, on both strands
    "fx_grouped_amplicons": (
        "select p_partkey as record_no, Project, Expected_Amplicon_Size_bp, case when "
        f"Primer_Sequence_5='' then middle when p_partkey % 2=1 then {rc('whole')} else whole end "
        "as seq from (select *, concat('GG',upper(Primer_Sequence_5),middle,"
        f"{rc('upper(Primer_Sequence_3)')},'CC') as whole from (select *, "
        f"{_hex_dna('cast(p_partkey as <S>)')} as middle from fx_sample_info) as t) as u"
    ),
    # one small file for every supplier
    "fx_supplier_reads": (
        "select concat('s',cast(s_suppkey as <S>)) as name, "
        f"{_hex_dna('s_name')} as seq, "
        "translate(md5(s_name),'0123456789abcdef','#$%&()*+,-./0123') as qual from supplier"
    ),
    # models before and behind the tag that ends a description
    "fx_header_tags": (
        "select concat('calls_',cast(o_custkey as <S>),'.bam') as file, o_orderkey as line_no, "
        "case o_orderkey % 4 when 0 then concat('@RG ID:a DS:runid=7 PL:ONT basecall_model=after_',"
        "cast(o_orderkey as <S>)) when 1 then concat('@RG ID:b DS:run note basecall_model=sup_',"
        "cast(o_orderkey % 13 as <S>),' more PU:x basecall_model=late') "
        "when 2 then concat('@RG ID:c PU:p DS:basecall_model=fast_',cast(o_orderkey % 7 as <S>)) "
        "else '@RG ID:d SM:s' end as line from orders"
    ),
    "fx_demux_files": (
        "select concat('/demux/kit',cast(l_suppkey % 7 as <S>),'/run',cast(l_orderkey % 50 as "
        "<S>),'/bam_pass',case when l_linenumber=7 then '' when l_partkey % 9=0 then "
        "'/lane1/bam_pass' else '' end,case when l_linenumber=6 then '' else "
        "concat('/barcode',lpad(cast(l_suppkey % 96+1 as <S>),2,'0')) end,'/f',"
        "cast(l_partkey as <S>),case when l_quantity>25 then '.bam' when l_quantity>20 then "
        "'.fq.fastq.gz' when l_quantity>10 then '.fq' else '.txt' end) as path from lineitem"
    ),
    "fx_header_lines": (
        "select concat('calls_',cast(o_custkey as <S>),'.bam') as file, o_orderkey as line_no, "
        "case o_orderkey % 5 when 0 then '@HD VN:1.6' "
        "when 1 then concat('@RG ID:r PU:x DS:runid=',cast(o_orderkey as <S>),"
        "' basecall_model=dna_',lower(o_orderstatus),'_',cast(o_orderkey % 11 as <S>),"
        "' modbase=none PL:ONT') "
        "when 2 then '@RG ID:q PL:ONT basecall_model=outside_ds' "
        "when 3 then concat('@RG ID:s DS:basecall_model=hac_',lower(o_orderstatus)) "
        "else '@PG ID:d DS:basecall_model=not_a_read_group' end as line from orders"
    ),
}

# Ordered text aggregation is spelled differently in Spark.
SPARK_VIEWS = {
    "fx_reference": (
        f"select listagg({_hex_dna('r_name')},'') within group (order by r_regionkey) as seq "
        "from region"
    )
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _needs(sql: str, names) -> list[str]:
    import re

    words = set(re.findall(r"\b\w+\b", sql))
    return [n for n in names if n in words]


def view_sql(name: str, dialect: str) -> str:
    text = VIEWS[name]
    if dialect == "spark":
        text = SPARK_VIEWS.get(name, text)
        return text.replace("<S>", "string").replace("<G>", "").replace("\\", "\\\\")
    return text.replace("<S>", "varchar").replace("<G>", ",'g'").replace("\\\\", "\\")


def with_views(sql: str) -> str:
    """Query text for the checking engine with the views it uses put in front."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _needs(text, VIEWS):
            if name not in ordered:
                visit(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    heads = [f"{n} as ({view_sql(n, 'duckdb')})" for n in ordered]
    body = sql.strip()
    if body.lower().startswith("with recursive"):
        return "with recursive " + ", ".join(heads + [body[len("with recursive") :].strip()])
    if body.lower().startswith("with "):
        return "with " + ", ".join(heads + [body[len("with ") :].strip()])
    return f"with {', '.join(heads)} {body}" if heads else body


def _dealt(texts: DataFrame) -> DataFrame:
    """Texts spread over the cores if the scan alone would keep only some of them busy.

    A large table has more splits than cores and is left as it is.
    """
    cores = texts.sparkSession.sparkContext.defaultParallelism
    if texts.rdd.getNumPartitions() >= cores:
        return texts
    return texts.repartition(cores, "doc_id")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a given table, as a DataFrame."""
    if name in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return _dealt(table) if name == "documents" else table
    sql = view_sql(name, "spark")
    inputs = {n: view(spark, sf_dir, n) for n in _needs(sql, [*TABLES, *VIEWS]) if n != name}
    for source in inputs:
        sql = sql.replace(f"from {source}", f"from {{{source}}}")
        sql = sql.replace(f"join {source}", f"join {{{source}}}")
    return spark.sql(sql, **inputs)
