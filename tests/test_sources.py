"""Readers on CSV files written by the test (inline inputs), including dirty rows."""

import os

from uptake.sources import readers


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_read_drops_two_header_shapes_and_dirty_rows(spark, tmp_path):
    d = tmp_path / "drops"
    h1 = ("State,Post_Code,NMI_BUS_RES,Sum of DER_Connections,Sum of Installed_DER_Capacity_kVA,"
          "Sum of Num_Solar_Connections,Sum of Solar_Capacity_kVA,Sum of Num_Battery_Connections,"
          "Sum of Battery_Capacity_kVA,Sum of Battery_Storage_kVAh,Sum of Other_Connections,"
          "Sum of Installed_OtherDER_Capacity_kVA\n")
    _write(str(d / "2021_07.csv"), h1 + "VIC,3000,RESIDENTIAL,1,2,3,4,5,6,7,8,9\n"
           "VIC,<5,RESIDENTIAL,1,2,3,4,5,6,7,8,9\n"
           "VIC, 3001 ,BUSINESS,1,2,3,4,5,6,7,8,9\n"
           "VIC,3002,None,1,2,3,4,5,6,7,8,9\n"
           "VIC,3003.9,BUSINESS,1,2,3,4,5,6,7,8,9\n")
    # second shape: columns in another order
    h2 = ("Post_Code,State,NMI_BUS_RES,Sum of Solar_Capacity_kVA,Sum of DER_Connections,Sum of Installed_DER_Capacity_kVA,"
          "Sum of Num_Solar_Connections,Sum of Num_Battery_Connections,"
          "Sum of Battery_Capacity_kVA,Sum of Battery_Storage_kVAh,Sum of Other_Connections,"
          "Sum of Installed_OtherDER_Capacity_kVA\n")
    _write(str(d / "2022_01.csv"), h2 + "4000,NSW,RESIDENTIAL,40,1,2,3,5,6,7,8,9\n")
    rows = {(r.Postcode, r.Year): r for r in readers.read_drops(spark, str(d)).collect()}
    assert set(rows) == {(3000, 2021), (3001, 2021), (3003, 2021), (4000, 2022)}
    assert rows[(4000, 2022)].SolarCapacity == 40.0 and rows[(4000, 2022)].State == "NSW"
    assert rows[(3000, 2021)].InstalledOtherderCapacity == 9.0


def test_read_dwellings_by_position(spark, tmp_path):
    p = str(tmp_path / "dw.csv")
    _write(p, "DWTSTRD,REGION,Region,TIME_PERIOD,OBS_VALUE\n_T,10050,Albury,2021,100\nH,10050,Albury,2021,60\n")
    rows = readers.read_dwellings(spark, p).collect()
    assert {(r.Type, r.LGA_2021, r.Region, r.TIME_PERIOD, r.OBS_VALUE) for r in rows} == {
        ("_T", 10050, "Albury", 2021, 100.0), ("H", 10050, "Albury", 2021, 60.0)
    }


def test_positional_readers_follow_each_header(spark, tmp_path):
    d = tmp_path / "dwellings"
    _write(str(d / "a.csv"), "DWTSTRD,REGION,Region,TIME_PERIOD,OBS_VALUE\n_T,10050,Albury,2021,100\n")
    _write(str(d / "b.csv"), "Region,OBS_VALUE,DWTSTRD,TIME_PERIOD,REGION\nBega,60,H,2022,10051\n")
    rows = readers.read_dwellings(spark, str(d)).collect()
    assert {(r.Type, r.LGA_2021, r.Region, r.TIME_PERIOD, r.OBS_VALUE) for r in rows} == {
        ("_T", 10050, "Albury", 2021, 100.0), ("H", 10051, "Bega", 2022, 60.0)
    }


def test_read_crosswalk_and_remoteness(spark, tmp_path):
    p = str(tmp_path / "cw.csv")
    _write(p, "LGA_CODE,LGA_NAME,POSTCODE\n10050,Albury,2640\nx,Nowhere,2641\n")
    got = {(r.Lga, r.Region, r.Postcode) for r in readers.read_crosswalk(spark, p).collect()}
    assert got == {(10050, "Albury", 2640), (None, "Nowhere", 2641)}
    q = str(tmp_path / "mmm.csv")
    _write(q, ",POA,AREA,MMM,MMM_AREA\n0,2640,10.5,2,3.0\n1,2640,10.5,5,7.0\n")
    got = {(r.Postcode, r.Area, r.MMM_Class, r.MMM_Area) for r in readers.read_remoteness(spark, q).collect()}
    assert got == {(2640, 10.5, "2", 3.0), (2640, 10.5, "5", 7.0)}


def test_read_indicators(spark, tmp_path):
    p = str(tmp_path / "pop.csv")
    _write(p, "Data Item,MEASURE,LGA_2021,Region,TIME_PERIOD,OBS_VALUE,Unit of Measure,Extra\n"
           "Population,ERP_P_20,10050,Albury,2021,55000,Persons,z\n")
    r = readers.read_indicators(spark, [p]).first()
    assert (r.DataItem, r.Measure, r.Lga, r.Region, r.TimePeriod, r.ObsValue, r.Unit) == (
        "Population", "ERP_P_20", 10050, "Albury", 2021, 55000.0, "Persons")


def test_sorted_csv_sink(spark, tmp_path):
    import glob

    from pyspark.sql import functions as F

    from uptake.sources import sinks

    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k")).repartition(5)
    out = str(tmp_path / "sorted")
    sinks.write_csv(df, out, order_by=["k"])
    values = []
    for f in sorted(glob.glob(out + "/part-*.csv")):
        with open(f) as fh:
            values += [int(x) for x in fh.read().split()[1:]]
    assert values == sorted(values) and len(values) == 5000
