"""Readers on small hand-written files with the edge cases of the source formats."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import catalog as CAT
from tessera.session import shared_path
from tessera.sources import delimited as DL
from tessera.sources import xml as XML


def _write(spark, name, text, encoding="utf-8"):
    folder = shared_path(spark, name).replace("file:", "")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "part.txt")
    with open(path, "w", encoding=encoding) as fh:
        fh.write(text)
    return path


def test_tab_header_driven(spark):
    text = ("productid\tPRODUCTNDC\tStrengthNumber\tEXTRA\n"
            " p1 \t0002-7510\t10\tx\n"
            "\t\t\t\n"
            "p2\t12345-678\t\ty\n")
    path = _write(spark, "ndc", text)
    df = DL.read_header_delimited(spark, path, {"product_id": ("PRODUCTID",), "ndc": ("PRODUCTNDC",),
                                                "strength": ("ACTIVE_NUMERATOR_STRENGTH", "STRENGTHNUMBER"),
                                                "dea": ("DEASCHEDULE",)})
    assert sorted(tuple(r) for r in df.collect()) == [("p1", "0002-7510", "10", ""), ("p2", "12345-678", "", "")]


def test_quoted_csv_bom_and_commas(spark):
    text = '﻿"loinc_num","Component","METHOD_TYP","Status"\n"1-8","Acyclovir, serum","","ACTIVE"\n"","","",""\n"2-6","X ""q""","M","DEPRECATED"\n'
    path = _write(spark, "loinc", text)
    df = DL.read_header_delimited(spark, path, {"num": ("LOINC_NUM",), "component": ("COMPONENT",),
                                                "method": ("METHOD_TYP",), "status": ("STATUS",)},
                                  sep=",", quoted=True)
    assert sorted(tuple(r) for r in df.collect()) == [("1-8", "Acyclovir, serum", "", "ACTIVE"),
                                                       ("2-6", 'X "q"', "M", "DEPRECATED")]


def test_relationship_sniffing_and_required(spark):
    comma = _write(spark, "rel_c", "ZCTA5,GEOID_COUNTY\n501,1001\n30301,13121\n")
    pipe = _write(spark, "rel_p", "zcta5ce20|geoid_cnty_20\n30301|13121\n")
    fields = {"zcta": ("ZCTA5", "ZCTA5CE20"), "county": ("GEOID_COUNTY", "GEOID_CNTY_20")}
    a = DL.read_relationship(spark, comma, fields, ["zcta", "county"], {"zcta": 5, "county": 5})
    b = DL.read_relationship(spark, pipe, fields, ["zcta", "county"], {"zcta": 5, "county": 5})
    assert sorted(tuple(r) for r in a.collect()) == [("00501", "01001"), ("30301", "13121")]
    assert [tuple(r) for r in b.collect()] == [("30301", "13121")]
    with pytest.raises(ValueError):
        DL.read_relationship(spark, pipe, {"zcta": ("ZCTA5",), "county": ("X",)}, ["zcta", "county"])


def test_code_map(spark):
    path = _write(spark, "fips", "ncei,fips,name\n1,1,Alabama\n 50 ,48,Texas\n,9,Blank\n")
    m = DL.read_code_map(spark, path, src="ncei", dst="fips", src_width=3, dst_width=2)
    assert sorted(tuple(r) for r in m.collect()) == [("001", "01"), ("050", "48")]


def test_alias_resolution_and_required():
    headers = ["State", "Primary RUCA Code 2020", "Tract Population, 2020", "Population Density (per square mile), 2020"]
    assert DL.pick_header(headers, exact=("primaryruca",), token=("primaryruca",)) == "Primary RUCA Code 2020"
    assert DL.pick_header(headers, token=("population",), without=("density",)) == "Tract Population, 2020"
    assert DL.pick_header(headers, exact=("populationdensity",), token=("density",)).startswith("Population Density")
    assert DL.pick_header(headers, exact=("zip",)) is None
    with pytest.raises(ValueError, match=r"\['GID_1', 'NAME_1'\]"):
        DL.require_columns(["GID_0"], ["GID_0", "GID_1", "NAME_1"])


def test_schema_problems_and_read_cast(spark):
    declared = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])
    df = spark.createDataFrame([(1, "2", "x")], "k long, v string, extra string")
    probs = DL.schema_problems(df, declared)
    assert "column k is bigint, declared string" in probs and "unexpected column extra" in probs
    path = shared_path(spark, "payload")
    df.write.parquet(path)
    back = DL.read_cast(spark, path, declared)
    assert back.schema == declared and back.first() == ("1", 2)


def test_xml_records_latin1(spark):
    xml = ('<?xml version="1.0" encoding="ISO-8859-1"?>\n<CVXCodes>'
           '<CVXInfo><ShortDescription>Vacuna é</ShortDescription><CVXCode> 54 </CVXCode><Notes></Notes>'
           '<Status>Non-US</Status><LastUpdated>3/20/2011</LastUpdated></CVXInfo>'
           '<CVXInfo><ShortDescription>B</ShortDescription><CVXCode>8</CVXCode><Notes>n</Notes>'
           '<Status>Active</Status><LastUpdated>1/1/2020</LastUpdated></CVXInfo></CVXCodes>')
    path = _write(spark, "cvx", xml, encoding="latin-1")
    df = XML.read_records(spark, path, "CVXInfo")
    rows = {r.CVXCode: r for r in df.collect()}
    assert rows["54"].Notes == "" and rows["54"].ShortDescription == "Vacuna é" and rows["8"].Status == "Active"


def test_xml_tree_pairs(spark):
    xml = ("<tabular>"
           "<chapter><name>1</name><section id=\"A00-A09\">"
           "<diag><name>A00</name><diag><name>A00.0</name></diag><diag><name>A00.1</name>"
           "<diag><name>A00.10</name></diag></diag></diag>"
           "<diag><name>A01</name></diag></section></chapter>"
           "<chapter><name>2</name><section id=\"C00-C14\"><diag><name>C00</name></diag></section></chapter>"
           "</tabular>")
    path = _write(spark, "tree", xml)
    pairs = XML.tree_pairs(spark, path, root_tag="chapter", group_tag="section", node_tag="diag")
    got = sorted(((r.code, r.parent, r.root, r.group) for r in pairs.collect()), key=lambda x: x[0])
    assert got == [("A00", None, "1", "A00-A09"), ("A00.0", "A00", "1", "A00-A09"), ("A00.1", "A00", "1", "A00-A09"),
                   ("A00.10", "A00.1", "1", "A00-A09"), ("A01", None, "1", "A00-A09"), ("C00", None, "2", "C00-C14")]


def test_override_record():
    @dataclasses.dataclass(frozen=True)
    class Entry:
        table: str
        owner: str
        description: str

    base = Entry("geo.state", "team", "base")
    out = CAT.override_record(base, {"description": "states", "table": "hijack"}, frozenset({"table"}))
    assert out == Entry("geo.state", "team", "states")
    with pytest.raises(ValueError):
        CAT.override_record(base, {"nope": 1})
    assert [CAT.layer_schema("geography", x) for x in ("raw", "processed", "analysis")] == ["geography_raw", "geography_processed", "geography"]
    assert CAT.dotted_name("Cat", "_ops", "t") == "Cat._ops.t"
    with pytest.raises(ValueError):
        CAT.dotted_name("Cat", "no space", "t")


def _wide_line(rtype, code, name, year, month, var, days):
    vals = [f"{v:.2f}" if isinstance(v, float) else str(v) for v in days]
    return ",".join([rtype, code, name, str(year), str(month), var] + vals)


def test_wide_day_lines(spark):
    from pyspark.sql import Row
    from tessera.sources import text as TX
    feb = [1.5] * 28 + [-999.99] * 3                 # February padding
    jan = [2.0, " 3.25 ", -999.99] + [0.0] * 28        # space-padded value, real missing day
    lines = [_wide_line("cty", "01001", '"Autauga, AL"', 2023, 2, "TAVG", feb), "",
             _wide_line("ste", "01", "Alabama", 2024, 1, "prcp", jan), "   "]
    df = spark.createDataFrame([Row(value=x) for x in lines])
    out = TX.wide_day_lines(df).collect()
    feb_rows = [r for r in out if r.region_code == "01001"]
    assert len(feb_rows) == 28 and {r.variable for r in feb_rows} == {"tavg"} and feb_rows[0].region_name == "Autauga, AL"
    jan_rows = {r.obs_date.day: r.value for r in out if r.region_code == "01"}
    assert len(jan_rows) == 31 and jan_rows[2] == 3.25 and jan_rows[3] is None
    bad = spark.createDataFrame([Row(value="cty,01001,X,2023,2,tavg,1.0")])
    with pytest.raises(Exception, match="expected 37 fields"):
        TX.wide_day_lines(bad).collect()


def test_wide_file_names(spark):
    from tessera.sources import text as TX
    names = spark.createDataFrame([("tavg-202401-cty-scaled.csv",), ("prcp-199912-ste-prelim.csv",),
                                   ("ncdd-202401-version.txt",), ("tavg-202401-cty-final.csv",)], "n string")
    got = names.select(*TX.name_fields(F.col("n"), TX.WIDE_FILE_PATTERN, TX.WIDE_FILE_FIELDS)) \
               .filter("variable IS NOT NULL").collect()
    assert [(r.variable, r.year, r.month, r.region_type, r.status) for r in got] == [
        ("tavg", "2024", "01", "cty", "scaled"), ("prcp", "1999", "12", "ste", "prelim")]


def test_conform_region(spark):
    from tessera.operators import conform as K
    state_map = spark.createDataFrame([("01", "01"), ("02", "04"), ("18", "11")], "src string, dst string")
    df = spark.createDataFrame([("ste", "02"), ("cty", "02001"), ("cty", "18511"), ("cty", "99001"), ("cty", "0201x"),
                                ("xx", "01")], "t string, c string")
    got = {(r.t, r.c): r.geoid for r in K.conform_region(df, "t", "c", state_map, {"18511": "11001"}).collect()}
    assert got == {("ste", "02"): "04", ("cty", "02001"): "04001", ("cty", "18511"): "11001", ("cty", "99001"): None,
                   ("cty", "0201x"): None, ("xx", "01"): None}


def test_fixed_width_layout_and_bad_flag(spark):
    from pyspark.sql import Row
    from tessera.sources import text as TX
    spans = {"code": (1, 7), "flag": (9, 1), "short": (11, 10), "long": (22, None)}
    lines = ["A000001 1 Short one  Long text one", "A000002 0 Short two  ", "HEADER", "B000003 1 Third      "]
    df = TX.fixed_width(spark.createDataFrame([Row(value=x) for x in lines]), spans, min_len=16)
    rows = {r.code: (r.flag, r.short.strip(), (r.long or "").strip()) for r in df.collect()}
    assert rows == {"A000001": ("1", "Short one", "Long text one"), "A000002": ("0", "Short two", ""),
                    "B000003": ("1", "Third", "")}  # the short HEADER line is skipped
    flag = TX.strict_flag(F.col("flag"), "billable flag")
    bad = TX.fixed_width(spark.createDataFrame([Row(value="C000004 7 Bad flag   ")]), spans, min_len=16)
    with pytest.raises(Exception, match="bad billable flag"):
        bad.select(flag).collect()


def test_relationship_read_keeps_customers_past_five_digits(spark, tmp_path):
    """Every customer gives a row in both vintages; the reader's rule for an over-wide id is NULL."""
    from tessera.plans import readers
    ids = [1, 99999, 100000, 150000]
    spark.createDataFrame([(i, 7) for i in ids], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    got = [tuple(r) for r in readers.relationship_read(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(((v, z, "007") for v in ("comma", "pipe") for z in ("00001", "99999", None, None)), key=str)
