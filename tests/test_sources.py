import csv
import glob
import gzip

import pytest
from pyspark.sql import functions as F

from variantry.config import ConfigError
from variantry.names import ROW_ORDER, SOURCE_DATASET
from variantry.sinks import as_text, export_tsv, value_types, write_dataset
from variantry.sources.lists import read_dtypes, read_genes, read_genes_and_rsids, read_regions, read_renames
from variantry.sources.tables import read_dataset, read_delimited, read_path_list, read_sidecar, valid_datasets
from variantry.sources.vcf import header_lines, parse_header, read_vcf


def write(path, text):
    path.write_text(text)
    return str(path)


def exported(path):
    rows = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        with open(part, newline="") as handle:
            rows.append(list(csv.reader(handle, delimiter="\t")))
    return rows[0][0], [row for part in rows for row in part[1:]]


def test_tsv(spark, tmp_path):
    path = write(tmp_path / "fam.x.tsv", "A\tANN['HGVS.c']\tq\n1\tNA\t.\n\tnull\t\"a \"\"b\"\"\"\nNaN\tx\t None\n")
    df = read_delimited(spark, path)
    assert df.columns == ["A", "ANN['HGVS.c']", "q", ROW_ORDER]
    rows = [tuple(r) for r in df.orderBy(ROW_ORDER).drop(ROW_ORDER).collect()]
    assert rows == [("1", None, "."), (None, None, 'a "b"'), (None, "x", " None")]


def test_many_files(spark, tmp_path):
    a = write(tmp_path / "f1.a.tsv", "x\ty\n1\t2\n3\t4\n")
    b = write(tmp_path / "f2.a.tsv", "y\tx\n5\t6\n")
    c = write(tmp_path / "f3.a.tsv", "x\tz\n7\t8\n")
    df = read_delimited(spark, [a, b, c], provenance=True)
    rows = {tuple(r) for r in df.drop(ROW_ORDER).select("family", "filename", "x", "y", "z").collect()}
    assert rows == {
        ("f1", "f1.a.tsv", "1", "2", None), ("f1", "f1.a.tsv", "3", "4", None),
        ("f2", "f2.a.tsv", "6", "5", None), ("f3", "f3.a.tsv", "7", None, "8"),
    }
    with pytest.raises(ValueError):
        read_delimited(spark, write(tmp_path / "empty.tsv", ""))


def test_export(spark, tmp_path):
    df = spark.createDataFrame(
        [(2, 0.00001, True, ["a", "b"], 'say "x"', "d1", "f.tsv"), (1, None, None, ["a"], None, "d1", "f.tsv"), (3, 2.0, False, [], "", "d1", "f.tsv")],
        f"n long, d double, b boolean, l array<string>, t string, {SOURCE_DATASET} string, filename string",
    )
    path = str(tmp_path / "out")
    export_tsv(df, path, sort_by=["n"])
    header, rows = exported(path)
    assert header == ["n", "d", "b", "l", "t", "FILENAME", "filename"]
    assert rows == [
        ["1", ".", ".", "a", ".", "d1", "f.tsv"],
        ["2", "1e-05", "True", "a;b", 'say "x"', "d1", "f.tsv"],
        ["3", "2.0", "False", ".", "", "d1", "f.tsv"],
    ]
    export_tsv(df, path, sort_by=["n"], first=["t", "absent"], null_value="")
    assert exported(path)[0] == ["t", "FILENAME", "b", "d", "filename", "l", "n"]
    assert [r.l for r in as_text(df, "brackets").orderBy("n").collect()] == ["a", "['a', 'b']", None]
    export_tsv(df.limit(0), path)
    assert exported(path) == (["n", "d", "b", "l", "t", "FILENAME", "filename"], [])
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_dataset(spark, tmp_path):
    df = spark.createDataFrame([("007", 1, "x"), ("2", 2, "y")], "family string, n int, t string")
    path = str(tmp_path / "d")
    record = write_dataset(df, path, {"k": "v"}, partition_by=["family"])
    assert record["final_shape"] == [2, 3] and read_sidecar(spark, path) == record
    back = read_dataset(spark, path)
    assert back.columns == df.columns
    assert sorted(map(tuple, back.collect())) == [("007", 1, "x"), ("2", 2, "y")]
    assert read_sidecar(spark, str(tmp_path)) == {}


def test_value_types(spark):
    before = {f.name: f.dataType for f in spark.createDataFrame([], "a long, b double, c boolean, d long, t string").schema}
    after = spark.createDataFrame([("1", "0.5", "True", "1;2", "x"), (None, "1e-05", "False", "3", "y")], "a string, b string, c string, d string, t string")
    assert value_types(after, before) == {"a": "bigint", "b": "double", "c": "boolean"}


def test_path_lists(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    write_dataset(spark.createDataFrame([(1, "d")], f"a int, {SOURCE_DATASET} string"), good)
    (tmp_path / "bad").mkdir()
    listing = write(tmp_path / "list.txt", f"# comment\n\n{good}\n {bad} \n{tmp_path}/none\n")
    with pytest.warns(UserWarning, match="none"):
        assert read_path_list(spark, listing) == [good, bad]
    with pytest.warns(UserWarning, match="cannot be read"):
        assert list(valid_datasets(spark, [good, bad])) == [good]
    with pytest.raises(ValueError):
        valid_datasets(spark, [])
    with pytest.raises(FileNotFoundError):
        read_path_list(spark, f"{tmp_path}/none")


def test_gene_lists(spark, tmp_path):
    strict = write(tmp_path / "g.tsv", "Gene Symbol\tDescription\nA2M\tx\nBRCA1\ty\nA2M\tz\nNA\tz\n")
    assert sorted(r[0] for r in read_genes(spark, strict).collect()) == ["A2M", "BRCA1"]
    flexible = write(tmp_path / "g.csv", "RsID_paper,SYMBOL\nrs1,A\n15:29934686,B\n rs545889942*,\nrs1,A\n")
    genes, rsids = read_genes_and_rsids(spark, flexible)
    assert sorted(r[0] for r in genes.collect()) == ["A", "B"]
    assert sorted(r[0] for r in rsids.collect()) == ["rs1", "rs545889942*"]
    only = write(tmp_path / "o.tsv", "rs id\nrs5\n")
    assert read_genes_and_rsids(spark, only)[0] is None
    other = write(tmp_path / "n.tsv", "Functional gene(s)\nA\n")
    with pytest.raises(ConfigError):
        read_genes_and_rsids(spark, other)
    with pytest.raises(ConfigError):
        read_genes(spark, other)


def test_regions(spark, tmp_path):
    bed = write(tmp_path / "r.bed", "chr1\t100\t200\tname\nCHRX\t5\t6\tname\n")
    assert sorted(map(tuple, read_regions(spark, bed).collect())) == [("1", 100, 200), ("x", 5, 6)]
    with pytest.raises(ConfigError):
        read_regions(spark, write(tmp_path / "two.bed", "chr1\t1\n"))
    with pytest.raises(ConfigError):
        read_regions(spark, write(tmp_path / "bad.bed", "chr1\t1\tx\n"))


def test_dictionaries(tmp_path):
    assert read_dtypes(write(tmp_path / "d.csv", "column_name,dtype\nA,int64\n ANN['x'] , bool\n,x\n")) == {"A": "int64", "ANN['x']": "bool"}
    assert read_renames(write(tmp_path / "m.csv", "old,new\n# note\na,b,c\nx,y\n")) == {"old": "new", "x": "y"}


VCF = """##fileformat=VCFv4.2
##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth, in all">
##INFO=<ID=SOMATIC,Number=0,Type=Flag,Description="Flag">
##INFO=<ID=MQ,Number=1,Type=Float,Description="Quality">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
##INFO=<ID=END,Number=1,Type=Integer,Description="End">
##FORMAT=<ID=AD,Number=.,Type=Integer,Description="Depths">
##FORMAT=<ID=SB,Number=1,Type=Float,Description="Bias">
##INFO=<ID=LOF,Number=.,Type=String,Description="Loss">
##INFO=<ID=ANN,Number=.,Type=String,Description="Functional annotations: 'Allele | Gene_Name | cDNA.pos / cDNA.length | Distance | ERRORS / WARNINGS / INFO'">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tT\tN
1\t10\trs1\tGA\tG\t276\tPASS\tDP=5;MQ=60;ANN=G|X|72/35||,G|Y|||W1&W2\tGT:AD:SB\t0/1:28,33:-27.4\t./.:.:.
1\t20\t.\tG\tA,C\t.\tq10;s50\tSOMATIC;END=25;LOF=(X|1)\tGT:SB\t1|1:0\t0
"""


def test_vcf(spark, tmp_path):
    path = write(tmp_path / "x.vcf", VCF)
    df = read_vcf(spark, path)
    rows = [r.asDict() for r in df.orderBy(ROW_ORDER).collect()]
    assert df.columns == [
        "SAMPLE", "CHROM", "POS", "REF", "ALT", "QUAL", "FILTER", "ID", "INFO['DP']", "INFO['SOMATIC']", "INFO['MQ']",
        "INFO['END']", "INFO['LOF']", "FORMAT['GT']", "FORMAT['AD']", "FORMAT['SB']", "ANN['Allele']", "ANN['Gene_Name']",
        "ANN['cDNA.pos / cDNA.length']", "ANN['Distance']", "ANN['ERRORS / WARNINGS / INFO']", ROW_ORDER,
    ]
    assert [(r["POS"], r["ALT"], r["SAMPLE"], r["ANN['Gene_Name']"]) for r in rows] == [
        (10, "G", "T", "X"), (10, "G", "T", "Y"), (10, "G", "N", "X"), (10, "G", "N", "Y"),
        (20, "A", "T", None), (20, "A", "N", None), (20, "C", "T", None), (20, "C", "N", None),
    ]
    first, second, normal, late = rows[0], rows[1], rows[2], rows[4]
    assert (first["QUAL"], first["FILTER"], first["ID"], first["INFO['DP']"], first["INFO['SOMATIC']"]) == (276.0, "['PASS']", "rs1", 5, False)
    assert (first["INFO['MQ']"], first["INFO['END']"], first["INFO['LOF']"]) == (60.0, 11, None)
    assert (first["FORMAT['GT']"], first["FORMAT['AD']"], first["FORMAT['SB']"]) == ("(0, 1)", "(28, 33)", -27.399999618530273)
    assert first["ANN['cDNA.pos / cDNA.length']"] == "(start: 72, end: 107, length: 35)"
    assert (first["ANN['Distance']"], first["ANN['ERRORS / WARNINGS / INFO']"]) == (None, "[]")
    assert second["ANN['ERRORS / WARNINGS / INFO']"] == "['W1', 'W2']" and second["ANN['cDNA.pos / cDNA.length']"] is None
    assert (normal["FORMAT['GT']"], normal["FORMAT['AD']"], normal["FORMAT['SB']"]) == ("(None, None)", None, None)
    assert (late["QUAL"], late["FILTER"], late["ID"], late["INFO['SOMATIC']"]) == (None, "['q10', 's50']", None, True)
    assert (late["INFO['END']"], late["INFO['LOF']"], late["FORMAT['GT']"], late["FORMAT['AD']"]) == (25, "('(X|1)',)", "(1, 1)", None)
    assert rows[5]["FORMAT['SB']"] is None and rows[4]["FORMAT['SB']"] == 0.0


def test_vcf_header(spark, tmp_path):
    long = write(tmp_path / "l.vcf", "##contig=<ID=1>\n" * 3000 + VCF)
    assert parse_header(header_lines(spark, long)).samples == ("T", "N")
    with gzip.open(tmp_path / "x.vcf.gz", "wt") as handle:
        handle.write(VCF)
    assert read_vcf(spark, str(tmp_path / "x.vcf.gz")).count() == 8
    with pytest.raises(ValueError):
        header_lines(spark, write(tmp_path / "bad.vcf", "##x\n"))
    other = write(tmp_path / "y.vcf", VCF.replace("\tT\tN\n", "\tU\tV\n"))
    both = read_vcf(spark, [str(tmp_path / "l.vcf"), other])
    assert {r[0] for r in both.select("SAMPLE").distinct().collect()} == {"T", "N", "U", "V"}
    assert both.where(F.col("SAMPLE") == "U").count() == 4
