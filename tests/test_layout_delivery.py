import os

import pytest

from ampliframe.functions.labels import fastq_sample_name, is_fastq_path, safe_path_part
from ampliframe.operators import delivery, demux
from ampliframe.operators import layout as lay
from ampliframe.sources.files import list_files


def put(path, text="x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def plan(spark, rows, root, data, schema, **options):
    return lay.plan_fastq_layout(
        rows(data, schema), root, list_files(spark, root), barcode_col="barcode", **options
    )


SHEET = "barcode string, Project string, Expected_Amplicon_Size_bp string"


def test_plan_with_project(spark, rows, work):
    put(f"{work}/barcode01/r.fastq.gz")
    put(f"{work}/barcode02/r.fastq.gz")
    got = plan(
        spark, rows, work,
        [("barcode01", "Project A", "3500bp"), ("barcode02", "Project B", "1600 bp")],
        SHEET, project_col="Project", dry_run=True,
    ).orderBy("barcode").collect()
    assert [r["group"] for r in got] == ["Project_A_3500bp", "Project_B_1600_bp"]
    assert [r["status"] for r in got] == ["dry_run", "dry_run"]
    assert got[0]["destination"] == f"{work}/Project_A_3500bp/barcode01"


def test_missing_and_dropped_rows(spark, rows, work):
    put(f"{work}/other/r.txt")
    with pytest.warns(UserWarning) as told:
        got = plan(
            spark, rows, work, [("barcode01", "p", "3500bp"), ("barcode02", "p", None)], SHEET
        ).collect()
    assert any("not found" in str(w.message) for w in told)
    assert any("dropping 1 row" in str(w.message) for w in told)
    assert [(r["status"], r["project"]) for r in got] == [("missing_source", None)]


def test_existing_destination_is_refused(spark, rows, work):
    put(f"{work}/barcode01/r.fastq.gz")
    put(f"{work}/3500bp/barcode01/r.fastq.gz")
    data = [("barcode01", "p", "3500bp")]
    with pytest.raises(ValueError, match="already exist"):
        plan(spark, rows, work, data, SHEET)
    got = plan(spark, rows, work, data, SHEET, overwrite=True).first()
    assert got["destination_exists"] and got["status"] == "planned"


def test_layout_columns_are_required(spark, rows, work):
    with pytest.raises(ValueError, match="missing required column.*Expected_Amplicon_Size_bp"):
        lay.layout_rows(rows([("barcode01",)], "barcode string"), barcode_col="barcode")


def test_kit_labels(rows):
    df = rows(
        [("NB-07", "1bp"), ("x", "1bp"), (None, "1bp")],
        "Barcode_ID string, Expected_Amplicon_Size_bp string",
    )
    got = [(r["barcode"], r["valid"]) for r in lay.layout_rows(df).collect()]
    assert got == [("barcode07", True), ("barcodex", True), (None, False)]


def test_safe_parts(rows):
    df = rows([("  a / b:c  d__e? ",), ("_x_",), ("\t..",)], "s string")
    got = [r[0] for r in df.select(safe_path_part("s")).collect()]
    assert got == ["a_b_c_d_e", "x", ".."]


def test_fastq_names(rows):
    df = rows([("/a/x.fq.fastq.gz",), ("/a/y.fastq",), ("/a/z.txt",)], "path string")
    got = df.filter(is_fastq_path("path")).select(fastq_sample_name("path")).collect()
    assert [r[0] for r in got] == ["x", "y"]


def inventory(spark, rows, result, **columns):
    names = ["result_dir", "output_dir", *columns]
    kinds = ["boolean" if isinstance(v, bool) else "string" for v in columns.values()]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, ["string", "string", *kinds]))
    runs = rows([(result, "/out", *columns.values())], schema)
    listing = list_files(spark, os.path.dirname(result))
    return {r["label"]: r for r in delivery.deliverable_inventory(runs, listing).collect()}


def test_inventory(spark, rows, work):
    result, trim = f"{work}/result", f"{work}/trim"
    for name in ("all-consensus-seqs.fasta", "all-consensus-seqs.fasta.fai",
                 "all-consensus-seqs_trimmed.fasta", "params.json", "execution/trace.txt",
                 "barcode57/alignments/a.bam", "barcode58/alignments/a.bam", "sample_map.tsv",
                 "nested/barcode99/x"):
        put(f"{result}/{name}")
    for b in ("barcode57", "barcode58"):
        put(f"{trim}/{b}/Distribution_seqLength__sup__{b}.png")
        put(f"{trim}/{b}/other.png")
    got = inventory(
        spark, rows, result, sample_map=f"{result}/sample_map.tsv", fastq_pass_trim_dir=trim,
        include_execution=True,
    )
    assert set(got) == {
        "untrimmed_consensus", "consensus_fasta_index", "trimmed_consensus", "sample_map",
        "barcode57", "barcode58", "barcode57_read_length_plot", "barcode58_read_length_plot",
        "execution", "README",
    }
    assert all(r["exists"] for r in got.values())
    plot = got["barcode57_read_length_plot"]
    assert plot["destination"] == "/out/barcode57/Distribution_seqLength__sup__barcode57.png"
    assert got["README"]["source"] is None


def test_inventory_reports_absent_files(spark, rows, work):
    put(f"{work}/result/all-consensus-seqs_trimmed.fasta")
    got = inventory(spark, rows, f"{work}/result")
    assert not got["untrimmed_consensus"]["exists"] and got["trimmed_consensus"]["exists"]
    assert "sample_map" not in got and "execution" not in got


def evidence(rows, *items):
    return rows([("P1", *i) for i in items], "project string, role string, source string")


def test_manifest(rows):
    listing = rows([("/i/c.fa", 9), ("/i/s.csv", 5), ("/i/af.tsv", 3)], "path string, size bigint")
    df = evidence(rows, ("consensus", "/i/c.fa"), ("sample_sheet", "/i/s.csv"),
                  ("variants_af", "/i/af.tsv"))
    got = {r["label"]: r for r in delivery.checked_manifest(df, listing).collect()}
    assert set(got) == {"consensus_fasta", "consensus_fasta_index", "sample_sheet", "variants_af",
                        "consensus_stats"}
    assert got["sample_sheet"]["delivery_path"] == "00_metadata/s.csv"
    assert got["consensus_fasta"]["delivery_path"] == "01_consensus/consensus.fasta"


def test_unusable_evidence(rows):
    listing = rows([("/i/c.fa", 0)], "path string, size bigint")
    with pytest.raises(ValueError, match="empty"):
        delivery.checked_manifest(evidence(rows, ("consensus", "/i/c.fa")), listing)
    with pytest.raises(ValueError, match="missing"):
        delivery.checked_manifest(evidence(rows, ("consensus", "/i/d.fa")), listing)
    with pytest.raises(ValueError, match="unknown evidence role"):
        delivery.checked_manifest(evidence(rows, ("other", "/i/c.fa")), listing)


def test_only_names_of_indexes_are_looked_up(rows):
    names = [("a.fasta",), ("a.fasta",), ("b.fa",), ("b.fa.fai",), ("b.fa.fai",), ("C.BAM",), ("C.bai",)]
    missing = delivery.missing_indexes(rows([*names, ("d.bam",), ("d.bam.csi",), (None,)], "path string"))
    assert sorted(map(tuple, missing.collect())) == [
        ("a.fasta", "fasta"), ("a.fasta", "fasta"), ("d.bam", "bam")
    ]
    plan = missing._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_missing_indexes(rows):
    listing = rows(
        [(p,) for p in ("/a.fasta", "/b.fasta", "/b.fasta.fai", "/x.bam", "/y.bam", "/y.bai",
                        "/z.BAM", "/z.BAM.bai")],
        "path string",
    )
    got = {(r["path"], r["kind"]) for r in delivery.missing_indexes(listing).collect()}
    assert got == {("/a.fasta", "fasta"), ("/x.bam", "bam")}


def test_duplicate_names(rows):
    listing = rows([("/a/x.fq",), ("/b/x.fq",), ("/b/y.fq",)], "path string")
    assert [tuple(r) for r in delivery.duplicate_basenames(listing).collect()] == [("x.fq", 2)]
    with pytest.raises(ValueError, match="x.fq"):
        delivery.require_unique_basenames(listing)


def test_demux_tree(rows):
    listing = rows(
        [(p,) for p in (
            "/d/kit/run1/bam_pass/barcode01/a.bam", "/d/kit/run1/bam_pass/barcode01/b.bam",
            "/d/kit/run1/bam_pass/deep/barcode02/c.bam", "/d/kit/run2/bam_pass/direct.bam",
            "/d/kit/run2/bam_pass/notes/n.txt", "/d/kit/bam/other.bam")],
        "path string",
    )
    got = {(r["run_dir"], r["rel_path"], r["output"]) for r in demux.demux_tree(listing).collect()}
    assert got == {
        ("/d/kit/run1", "barcode01", "/d/kit/run1/fastq_pass_trim/barcode01/barcode01.fastq.gz"),
        ("/d/kit/run1", "deep/barcode02",
         "/d/kit/run1/fastq_pass_trim/deep/barcode02/barcode02.fastq.gz"),
    }
    runs = [r["run_dir"] for r in demux.run_directories(listing).collect()]
    assert runs == ["/d/kit/run1", "/d/kit/run2"]


def test_basecall_models(rows):
    lines = [
        ("a", 1, "@HD\tVN:1.6"),
        ("a", 2, "@RG\tID:1\tDS:runid=7 basecall_model=sup_v4 modbase=x\tPL:ONT"),
        ("a", 3, "@RG\tID:2\tDS:basecall_model=other"),
        ("b", 1, "@RG\tID:1\tPL:ONT basecall_model=outside"),
        ("c", 1, "@PG\tDS:basecall_model=no"),
        ("d", 1, "@RG\tDS:basecall_model=hac"),
    ]
    df = rows(lines, "file string, line_no int, line string")
    got = {r["file"]: r["model"] for r in demux.basecall_models(df).collect()}
    assert got == {"a": "sup_v4", "d": "hac"}
    with pytest.raises(ValueError, match="no basecall_model"):
        demux.require_models(df)


def test_every_conflict_is_told(spark, rows):
    from ampliframe.contracts import ProblemRows

    sheet = rows([(f"b{i:02d}", "3kb") for i in range(25)], "barcode string, size string")
    files = rows([(f"/d/3kb/b{i:02d}/x.fastq",) for i in range(25)], "path string")
    with pytest.warns(UserWarning, match="b00, b01.*b24"), pytest.raises(ProblemRows) as caught:
        lay.plan_fastq_layout(
            sheet, "/d", files, amplicon_size_col="size", barcode_col="barcode")
    assert all(f"/d/3kb/b{i:02d}" in str(caught.value) for i in range(25))
    assert caught.value.problems.count() == 25


def test_problem_tables_hold_everything(spark, rows):
    from ampliframe.contracts import ProblemRows

    files = rows([(f"/d/{x}/f{i}.fq",) for i in range(30) for x in "ab"], "path string")
    with pytest.raises(ProblemRows, match="30 row") as caught:
        delivery.require_unique_basenames(files)
    assert caught.value.problems.count() == 30


def test_a_path_listed_twice_is_one_file(spark, rows):
    evidence = rows([("p", "notes", "/d/n")], "project string, role string, source string")
    files = rows([("/d/n", 0), ("/d/n", 0)], "path string, size long")
    assert delivery.evidence_problems(evidence, files).count() == 1


def test_whole_numbers_name_groups_without_a_point(spark, rows):
    sheet = rows(
        [("b1", 3500.0), ("b2", 1.5), ("b3", None)], "barcode string, size double")
    got = lay.layout_rows(sheet, amplicon_size_col="size", barcode_col="barcode").collect()
    assert [(r["group"], r["valid"]) for r in got] == [
        ("3500", True), ("1.5", True), (None, False)]
