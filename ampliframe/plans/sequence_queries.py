"""Primer, consensus and orientation queries with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ampliframe.functions.dna import (
    BASE_MASK,
    clean_sequence,
    complement_text,
    first_exact_hit,
    first_hit_declarative,
)
from ampliframe.functions.dna import reverse_complement as rc_of
from ampliframe.functions.labels import name_or_numbered
from ampliframe.operators import consensus as cons
from ampliframe.operators import orient
from ampliframe.operators import primers as pr
from ampliframe.plans.fixtures import F_PRIMER, R_PRIMER, view
from ampliframe.sources.fasta import name_all_or_number

KEYS = ["Project", "Expected_Amplicon_Size_bp"]


def reverse_complement(spark, sf_dir):
    return view(spark, sf_dir, "fx_seq").select("doc_id", rc_of("seq").alias("rc_seq"))


def cleaned_sequences(spark, sf_dir):
    return view(spark, sf_dir, "fx_raw_seq").select("doc_id", clean_sequence("seq").alias("seq"))


def default_names(spark, sf_dir):
    reads = view(spark, sf_dir, "fx_reads")
    return reads.select("record_no", name_or_numbered("name", "record_no", "sanger").alias("name"))


def file_default_names(spark, sf_dir):
    records = view(spark, sf_dir, "documents").select(
        F.col("source").alias("file"),
        F.col("doc_id").alias("record_no"),
        F.when(F.col("doc_id") % 97 == 0, "").otherwise(
            F.concat(F.lit("d"), F.col("doc_id").cast("string"))
        ).alias("name"),
    )
    return name_all_or_number(records)


def primer_pairs(spark, sf_dir):
    rows = pr.matching_rows(view(spark, sf_dir, "fx_sample_info"), size="1600bp")
    return pr.distinct_pairs(rows)


def primer_pairs_by_group(spark, sf_dir):
    return pr.primer_pairs_by_group(view(spark, sf_dir, "fx_sample_info"), KEYS)


def primer_hits(spark, sf_dir):
    found = pr.primer_hits(view(spark, sf_dir, "fx_amplicon"), F_PRIMER, R_PRIMER, 2)
    return found.select("doc_id", "f_start", "rc_r_start", "r_start", "rc_f_start")


def primer_hits_declarative(spark, sf_dir):
    """The same search in plain expressions, on the shorter lines of the texts' reads."""
    reads = view(spark, sf_dir, "fx_reads")
    return reads.select(
        "record_no", first_hit_declarative("seq", "ACGTMNCA", 2).alias("start")
    )


def exact_primer_hits(spark, sf_dir):
    return view(spark, sf_dir, "fx_amplicon").select(
        "doc_id", first_exact_hit("seq", F_PRIMER).alias("start")
    )


def primer_trim(spark, sf_dir):
    trimmed = pr.trim_amplicons(view(spark, sf_dir, "fx_amplicon"), F_PRIMER, R_PRIMER, 2)
    return trimmed.select("doc_id", "trimmed_seq")


def trim_summary(spark, sf_dir):
    named = view(spark, sf_dir, "fx_amplicon").withColumn(
        "name", F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    )
    return pr.trim_summary(pr.trim_amplicons(named, F_PRIMER, R_PRIMER, 2))


def primer_trim_by_group(spark, sf_dir):
    """Every part sequence against the primer pair of its own project and size."""
    sheet = view(spark, sf_dir, "fx_sample_info")
    pairs = pr.primer_pairs_by_group(sheet, KEYS).filter("n_pairs = 1")
    name = F.concat(F.lit("c"), F.col("p_partkey").cast("string"))
    seqs = view(spark, sf_dir, "fx_cons1").join(
        sheet.select(name.alias("name"), *KEYS), "name"
    )
    trimmed = pr.trim_amplicons(seqs, max_mismatch=1, pairs=pairs, pair_keys=KEYS)
    return trimmed.select(
        "name", "record_no", "trimmed", "orientation", "start", "end", "trimmed_seq"
    )


def planted_trim_by_group(spark, sf_dir):
    """Amplicons of every project and size between their own primers, on both strands."""
    pairs = pr.primer_pairs_by_group(view(spark, sf_dir, "fx_sample_info"), KEYS)
    seqs = view(spark, sf_dir, "fx_grouped_amplicons")
    trimmed = pr.trim_amplicons(
        seqs, max_mismatch=1, pairs=pairs.filter("n_pairs = 1"), pair_keys=KEYS
    )
    return trimmed.select("record_no", "trimmed", "orientation", "start", "end", "trimmed_seq")


def _sets(spark, sf_dir, kind="cons"):
    return view(spark, sf_dir, f"fx_{kind}1"), view(spark, sf_dir, f"fx_{kind}2")


def shared_names(spark, sf_dir):
    return cons.shared_names(*_sets(spark, sf_dir))


def consensus_pairs(spark, sf_dir):
    return cons.pairs_by_name(*_sets(spark, sf_dir)).select("seq1_name", "seq1", "seq2")


def consensus_distance(spark, sf_dir):
    return cons.consensus_distances(*_sets(spark, sf_dir))


def consensus_compare(spark, sf_dir):
    compared = cons.compare_consensus(*_sets(spark, sf_dir))
    ungapped = lambda c: F.regexp_replace(c, "-", "")
    return compared.select(
        "seq1_name",
        "seq2_name",
        "distance",
        "seq1_len",
        "seq2_len",
        "seq2_orientation",
        "seq1",
        "seq2",
        (ungapped("aligned_seq1") == F.col("seq1")).alias("seq1_kept"),
        (
            ungapped("aligned_seq2")
            == F.when(F.col("seq2_orientation") == "forward", F.col("seq2")).otherwise(
                rc_of("seq2")
            )
        ).alias("seq2_kept"),
    )


def consensus_map_compare(spark, sf_dir):
    entries = view(spark, sf_dir, "fx_map")
    return cons.consensus_distances(*_sets(spark, sf_dir), entries, keep_order=True)


def sequence_differences(spark, sf_dir):
    """Differences of every pair, counted per pair and kind so that ties cannot matter."""
    listed = cons.sequence_differences(cons.pairs_by_name(*_sets(spark, sf_dir)))
    return listed.groupBy("seq1_name", "orientation", "seq2_aligned_as").agg(
        F.count(F.lit(1)).alias("n_diff"),
        F.count_if(F.col("seq1_pos").isNull() != F.col("seq2_pos").isNull()).alias("n_gap"),
    )


def difference_rows(spark, sf_dir):
    return cons.sequence_differences(cons.pairs_by_name(*_sets(spark, sf_dir)))


def document_distance(spark, sf_dir):
    return cons.consensus_distances(*_sets(spark, sf_dir, "doc"))


def document_compare(spark, sf_dir):
    return cons.compare_consensus(*_sets(spark, sf_dir, "doc"))


def _oriented(spark, sf_dir):
    target = orient.one_reference(view(spark, sf_dir, "fx_reference"))
    reads = orient.cleaned_reads(view(spark, sf_dir, "fx_reads"))
    return target, orient.orient_reads(target, reads)


def strand_orientation(spark, sf_dir):
    return _oriented(spark, sf_dir)[1].drop("oriented_seq", "record_no")


def oriented_reads(spark, sf_dir):
    return _oriented(spark, sf_dir)[1].select("sample", "oriented_seq")


def document_orientation(spark, sf_dir):
    target = orient.one_reference(view(spark, sf_dir, "fx_reference"))
    documents = view(spark, sf_dir, "fx_doc1")
    return orient.orient_reads(target, documents).drop("oriented_seq")


def read_stack(spark, sf_dir):
    target, oriented = _oriented(spark, sf_dir)
    return orient.read_stack(target, oriented)


def read_stack_invariants(spark, sf_dir):
    """Every row of the stack without its gaps, and whether all rows are equally wide."""
    stack = read_stack(spark, sf_dir)
    width = F.length("aligned_seq")
    widths = stack.agg(F.min(width).alias("least"), F.max(width).alias("most"))
    return stack.crossJoin(F.broadcast(widths)).select(
        "ref_name",
        "row_no",
        "name",
        F.regexp_replace("aligned_seq", "-", "").alias("kept_seq"),
        (F.col("least") == F.col("most")).alias("same_width"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        reverse_complement,
        cleaned_sequences,
        default_names,
        file_default_names,
        primer_pairs,
        primer_pairs_by_group,
        primer_hits,
        primer_hits_declarative,
        exact_primer_hits,
        primer_trim,
        trim_summary,
        primer_trim_by_group,
        planted_trim_by_group,
        shared_names,
        consensus_pairs,
        consensus_distance,
        consensus_compare,
        consensus_map_compare,
        sequence_differences,
        difference_rows,
        document_distance,
        document_compare,
        strand_orientation,
        oriented_reads,
        document_orientation,
        read_stack,
        read_stack_invariants,
    )
}

# ---- checking SQL ---------------------------------------------------------------------------


def _rc_sql(expression: str) -> str:
    return f"reverse(translate({expression},'ACGTMRWSYKVHDBN','TGCAKYWSRMBDHVN'))"


# position of a code in this text is its four-bit base set
_BY_MASK = "".join(sorted(BASE_MASK, key=BASE_MASK.get))


def _hit_sql(masks: str, primer: str, max_mismatch: int) -> str:
    """First start by brute force over a list of base sets."""
    misses = "+".join(
        f"(case when {masks}[i+{k}] & {BASE_MASK[b]} = 0 then 1 else 0 end)"
        for k, b in enumerate(primer)
    )
    places = f"range(1,greatest(len({masks})-{len(primer) - 2},1))"
    return f"cast(list_filter({places}, lambda i: {misses} <= {max_mismatch})[1] as integer)"


_MASKS = f"list_transform(string_split(seq,''), lambda c: strpos('{_BY_MASK}',c))"
_HITS = (
    f"hits as (select *, {_hit_sql('m', F_PRIMER, 2)} as f_start, "
    f"{_hit_sql('m', complement_text(R_PRIMER), 2)} as rc_r_start, "
    f"{_hit_sql('m', R_PRIMER, 2)} as r_start, "
    f"{_hit_sql('m', complement_text(F_PRIMER), 2)} as rc_f_start "
    f"from (select *, {_MASKS} as m from fx_amplicon))"
)


def _trim_sql(f_length: str, r_length: str, keep: str) -> str:
    return f"""
  cand as (select *, f_start<rc_r_start as is_f, r_start<rc_f_start as is_r,
    rc_r_start+{r_length}-1 as f_end, rc_f_start+{f_length}-1 as r_end from hits),
  pick as (select *, case when is_f and (is_r is not true or f_end-f_start>=r_end-r_start)
    then 'forward' when is_r then 'reverse_complement' end as orientation from cand),
  cut as (select {keep}, seq, orientation is not null as trimmed, orientation,
    cast(case orientation when 'forward' then f_start when 'reverse_complement' then r_start end
      as integer) as "start",
    cast(case orientation when 'forward' then f_end when 'reverse_complement' then r_end end
      as integer) as "end" from pick),
  done as (select *, case when orientation='forward' then substr(seq,"start","end"-"start"+1)
    when orientation='reverse_complement' then
      {_rc_sql('substr(seq,"start","end"-"start"+1)')} else seq end as trimmed_seq from cut)"""


_PAIR_ROWS = """pairs as (select distinct {0} upper(regexp_replace(Primer_Sequence_5,
    '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$','','g')) as f_primer, upper(regexp_replace(
    Primer_Sequence_3,'^[ \\t\\r\\n]+|[ \\t\\r\\n]+$','','g')) as r_primer from fx_sample_info
    where Primer_Sequence_5<>'' and Primer_Sequence_3<>'' {1})"""
_BY_GROUP = (
    _PAIR_ROWS.format("Project, Expected_Amplicon_Size_bp,", "")
    + """, grouped as (select Project, Expected_Amplicon_Size_bp, count(*) as n_pairs,
    case when count(*)=1 then min(f_primer) end as f_primer,
    case when count(*)=1 then min(r_primer) end as r_primer from pairs group by 1,2)"""
)


def _row_hit_sql(primer: str, max_mismatch: int) -> str:
    """Brute-force search for a primer that is itself a column of base sets."""
    misses = (
        f"len(list_filter(range(0,len({primer})), lambda k: m[i+k] & {primer}[k+1] = 0))"
    )
    places = f"range(1,greatest(len(m)-len({primer})+2,1))"
    return f"cast(list_filter({places}, lambda i: {misses} <= {max_mismatch})[1] as integer)"


def _mask_list(expression: str) -> str:
    return f"list_transform(string_split({expression},''), lambda c: strpos('{_BY_MASK}',c))"


def _by_group_sql(seqs: str, keys: str) -> str:
    """Trimming of `seqs`, each row with the primers of its group."""
    return f"""with {_BY_GROUP}, seqs as ({seqs}),
      hits as (select *, {_row_hit_sql('pf', 1)} as f_start, {_row_hit_sql('prr', 1)}
        as rc_r_start, {_row_hit_sql('pr', 1)} as r_start, {_row_hit_sql('pfr', 1)}
        as rc_f_start from (select *, {_MASKS} as m, {_mask_list('f_primer')} as pf,
        {_mask_list('r_primer')} as pr, {_mask_list(_rc_sql('f_primer'))} as pfr,
        {_mask_list(_rc_sql('r_primer'))} as prr from seqs)),
      {_trim_sql('length(f_primer)', 'length(r_primer)', keys)}
      select {keys}, trimmed, orientation, "start", "end", trimmed_seq from done"""


_FIRST = (
    "(select name, arg_min(seq,record_no) as seq from {0} group by name)"
)
_PAIRED = (
    f"paired as (select a.name as seq1_name, b.name as seq2_name, a.seq as seq1, b.seq as seq2 "
    f"from {_FIRST.format('fx_cons1')} as a join {_FIRST.format('fx_cons2')} as b "
    "on a.name=b.name)"
)
_MAPPED = (
    "paired as (select m.seq1_name, m.seq2_name, m.pair_no, a.seq as seq1, b.seq as seq2 from "
    f"fx_map as m join {_FIRST.format('fx_cons1')} as a on a.name=m.seq1_name join "
    f"{_FIRST.format('fx_cons2')} as b on b.name=m.seq2_name)"
)

# default scores times 1e9, room for differences in five more digits
_UNIT = 100_000
_MATCH = 1_981_756_131 * _UNIT
_MISMATCH = -5_899_285_636 * _UNIT - 1
_OPEN = 10_000_000_000 * _UNIT
_EXTEND = 4_000_000_000 * _UNIT + 1


def affine_steps(match: int, mismatch: int, opening: int, extend: int, local: bool) -> str:
    """One recursion step: row i of the score matrix of every distinct pair, as lists."""
    floor = ",0" if local else ""
    first = "0" if local else "e2[1]"
    return f"""
  select k, a, b, i+1, h2, e2, greatest(best, {'list_max(h2)' if local else '0'}) from (
   select *, list_transform(range(1,len(t)+1), lambda j: case when j=1 then t[1] else greatest(
     t[j], list_max(u[1:j-1])-{opening}-(j-1)*{extend}) end) as h2 from (
    select *, list_transform(range(1,len(t)+1), lambda j: t[j]+(j-1)*{extend}) as u from (
     select *, list_transform(range(1,len(h)+1), lambda j: case when j=1 then {first} else
       greatest(e2[j], h[j-1]+case when b[j-1]=a[i+1] then {match} else {mismatch} end{floor})
       end) as t from (
      select *, list_transform(range(1,len(h)+1),
        lambda j: greatest(e[j], h[j]-{opening})-{extend}) as e2
      from dp where i<len(a)))))"""


def _distance_sql(paired: str, tail: str) -> str:
    start = f"""select k, a, b, cast(0 as bigint) as i,
      list_transform(range(0,len(b)+1), lambda j: case when j=0 then cast(0 as bigint) else
        -{_OPEN}-j*{_EXTEND} end) as h,
      list_transform(range(0,len(b)+1), lambda j: cast(-2000000000000000000 as bigint)) as e,
      cast(0 as bigint) as best from keys"""
    return f"""with recursive {paired},
 work as (select distinct seq1, seq2 from paired),
 keys as (select row(seq1,seq2,false) as k, string_split(seq1,'') as a, string_split(seq2,'') as b
   from work union all select row(seq1,seq2,true), string_split(seq1,''),
   string_split({_rc_sql('seq2')},'') from work),
 dp(k,a,b,i,h,e,best) as ({start} union all
 {affine_steps(_MATCH, _MISMATCH, _OPEN, _EXTEND, False)}),
 ends as (select k, ((-h[len(h)]) % {_UNIT} + {_UNIT}) % {_UNIT} as d from dp where i=len(a)),
 best as (select w.seq1, w.seq2, f.d as fd, r.d as rd from work as w
   join ends as f on f.k=row(w.seq1,w.seq2,false) join ends as r on r.k=row(w.seq1,w.seq2,true)),
 answer as (select p.*, cast(least(fd,rd) as integer) as distance,
   cast(length(p.seq1) as integer) as seq1_len, cast(length(p.seq2) as integer) as seq2_len,
   case when rd<fd then 'reverse_complement' else 'forward' end as seq2_orientation
   from paired as p join best as b on b.seq1=p.seq1 and b.seq2=p.seq2)
 {tail}"""


_DISTANCE_COLUMNS = (
    "select seq1_name, seq2_name, distance, seq1_len, seq2_len, seq2_orientation"
)

# What the edits of the second set must show, without aligning: a lost base at the last place of
# its run of equal bases, a substitution in the turned sequence, and two bases more, as late as
# they can stand.
_DIFFERENCE_ROWS = f"""with {_PAIRED},
 keyed as (select *, cast(substr(seq1_name,2) as bigint) % 4 as kind, length(seq2) as len2,
   {_rc_sql('seq2')} as turned from paired),
 lost as (select *, 11+length(regexp_extract(substr(seq1,11),concat('^',substr(seq1,11,1),'+')))-1
   as place from keyed where kind=1),
 more as (select *, length(regexp_extract(substr(seq1,21),'^(GT)*G?')) as moved from keyed
   where kind=3)
select place as aln_pos, seq1_name, place as seq1_pos, substr(seq1,place,1) as seq1_base, seq2_name,
  cast(null as integer) as seq2_pos, '-' as seq2_base, 'forward' as orientation,
  'seq2_original' as seq2_aligned_as from lost
union all select 20, seq1_name, 20, substr(seq1,20,1), seq2_name, len2-20+1, 'A',
  'reverse_complement', 'seq2_reverse_complement' from keyed
  where kind=2 and substr(seq1,20,1)<>'A'
union all select 20+moved+i, seq1_name, null, '-', seq2_name, len2-(20+moved+i)+1,
  substr(turned,20+moved+i,1), 'reverse_complement', 'seq2_reverse_complement'
  from more, unnest([1,2]) as u(i)"""

# Short texts are aligned by the tables above. Of longer ones the edits leave no better answer:
# lengths that differ need a gap, and equal lengths a substitution.
_DOC_PAIRS = (
    f"all_pairs as (select a.name as seq1_name, b.name as seq2_name, a.seq as seq1, b.seq as seq2 "
    f"from {_FIRST.format('fx_doc1')} as a join {_FIRST.format('fx_doc2')} as b "
    "on a.name=b.name)"
)
_SHORT_DOCS = (
    _DOC_PAIRS + ", paired as (select * from all_pairs where length(seq1) between 1 and 23 "
    "and length(seq2)>0)"
)
_LONG_DOCS = """union all select seq1_name, seq2_name, cast(case
   when least(length(seq1),length(seq2))=0 then greatest(length(seq1),length(seq2))
   when kind=0 then 0 when kind=1 then 1 when kind=3 then 2
   when substr(seq1,20,1)='A' then 0 else 1 end as integer),
  cast(length(seq1) as integer), cast(length(seq2) as integer),
  case when kind<2 or least(length(seq1),length(seq2))=0 then 'forward'
    else 'reverse_complement' end
  from (select *, cast(substr(seq1_name,2) as bigint) % 4 as kind from all_pairs)
  where length(seq1)>23 or least(length(seq1),length(seq2))=0"""

# The reference is walked base by base, the lists run over the read: scores are symmetric.
_STRANDS = f"""with recursive
 named as (select record_no, case when name='' or name is null then
   concat('sanger_',record_no) else name end as sample, seq from fx_reads),
 keys as (select row(s,false) as k, string_split(r.seq,'') as a, string_split(s,'') as b
   from (select distinct seq as s from named), fx_reference as r
   union all select row(s,true), string_split(r.seq,''), string_split({_rc_sql('s')},'')
   from (select distinct seq as s from named), fx_reference as r),
 dp(k,a,b,i,h,e,best) as (select k, a, b, cast(0 as bigint),
   list_transform(range(0,len(b)+1), lambda j: cast(0 as bigint)),
   list_transform(range(0,len(b)+1), lambda j: cast(-1000000000 as bigint)),
   cast(0 as bigint) from keys union all
 {affine_steps(2, -3, 5, 2, True)}),
 ends as (select k, best from dp where i=len(a)),
 scored as (select n.*, cast(f.best as double) as forward_score,
   cast(r.best as double) as reverse_score from named as n
   join ends as f on f.k=row(n.seq,false) join ends as r on r.k=row(n.seq,true))
"""

ORACLES = {
    "reverse_complement": f"select doc_id, {_rc_sql('seq')} as rc_seq from fx_seq",
    "cleaned_sequences": (
        "select doc_id, upper(regexp_replace(seq,'\\s+','','g')) as seq from fx_raw_seq"
    ),
    "default_names": """select record_no, case when name='' or name is null then
      concat('sanger_',record_no) else name end as name from fx_reads""",
    "file_default_names": """select source as file, doc_id as record_no,
      case when bool_or(doc_id % 97=0) over (partition by source) then concat('seq',doc_id)
      else concat('d',doc_id) end as name from documents""",
    "primer_pairs": "with "
    + _PAIR_ROWS.format("", "and Expected_Amplicon_Size_bp='1600bp'")
    + " select * from pairs",
    "primer_pairs_by_group": f"with {_BY_GROUP} select * from grouped",
    "primer_hits": f"""with {_HITS}
      select doc_id, f_start, rc_r_start, r_start, rc_f_start from hits""",
    "primer_hits_declarative": (
        f"select record_no, {_hit_sql('m', 'ACGTMNCA', 2)} as \"start\" from "
        f"(select *, {_MASKS} as m from fx_reads)"
    ),
    "exact_primer_hits": (
        f"select doc_id, {_hit_sql('m', F_PRIMER, 0)} as \"start\" from "
        f"(select *, {_MASKS} as m from fx_amplicon)"
    ),
    "primer_trim": f"with {_HITS}, {_trim_sql('20', '22', 'doc_id')} "
    "select doc_id, trimmed_seq from done",
    "trim_summary": f"with {_HITS}, {_trim_sql('20', '22', 'doc_id')} "
    """select concat('d',doc_id) as seq_name, trimmed, orientation, "start", "end",
      cast(length(seq) as integer) as input_length,
      cast(length(trimmed_seq) as integer) as output_length,
      concat('d',doc_id,' trimmed=',case when trimmed then 'TRUE' else 'FALSE' end,
        ';orientation=',coalesce(orientation,'NA'),';start=',coalesce(cast("start" as varchar),
        'NA'),';end=',coalesce(cast("end" as varchar),'NA')) as output_name from done""",
    "primer_trim_by_group": _by_group_sql(
        """select c.name, c.record_no, c.seq, f_primer, r_primer from fx_cons1 as c
        join fx_sample_info as s on concat('c',s.p_partkey)=c.name join grouped as g
        on g.Project=s.Project and g.Expected_Amplicon_Size_bp=s.Expected_Amplicon_Size_bp
        where n_pairs=1""",
        "name, record_no",
    ),
    "planted_trim_by_group": _by_group_sql(
        """select record_no, seq, f_primer, r_primer from fx_grouped_amplicons as s
        join grouped as g on g.Project=s.Project
        and g.Expected_Amplicon_Size_bp=s.Expected_Amplicon_Size_bp where n_pairs=1""",
        "record_no",
    ),
    "shared_names": "select name from fx_cons1 intersect select name from fx_cons2",
    "consensus_pairs": f"with {_PAIRED} select seq1_name, seq1, seq2 from paired",
    "consensus_distance": _distance_sql(_PAIRED, _DISTANCE_COLUMNS + " from answer"),
    "consensus_compare": _distance_sql(
        _PAIRED,
        _DISTANCE_COLUMNS
        + ", seq1, seq2, true as seq1_kept, true as seq2_kept from answer",
    ),
    "consensus_map_compare": _distance_sql(
        _MAPPED, _DISTANCE_COLUMNS + ", pair_no from answer"
    ),
    "sequence_differences": _distance_sql(
        _PAIRED,
        "select seq1_name, seq2_orientation as orientation, case when seq2_orientation="
        "'forward' then 'seq2_original' else 'seq2_reverse_complement' end as seq2_aligned_as, "
        "cast(distance as bigint) as n_diff, cast(abs(seq1_len-seq2_len) as bigint) as n_gap "
        "from answer where distance>0",
    ),
    "difference_rows": _DIFFERENCE_ROWS,
    "document_distance": _distance_sql(
        _SHORT_DOCS, _DISTANCE_COLUMNS + " from answer " + _LONG_DOCS
    ),
    "strand_orientation": _STRANDS
    + """select sample, case when reverse_score>forward_score then 'reverse_complement' else
      'forward' end as direction, forward_score, reverse_score,
      greatest(forward_score,reverse_score) as selected_score,
      abs(forward_score-reverse_score) as score_delta from scored""",
    "read_stack_invariants": _STRANDS
    + f"""select 'reference' as ref_name, cast(record_no as bigint) as row_no, sample as name,
      case when reverse_score>forward_score then {_rc_sql('seq')} else seq end as kept_seq,
      true as same_width from scored
      union all select 'reference', 0, 'reference', seq, true from fx_reference""",
    "oriented_reads": _STRANDS
    + f"""select sample, case when reverse_score>forward_score then {_rc_sql('seq')} else seq end
      as oriented_seq from scored""",
}
