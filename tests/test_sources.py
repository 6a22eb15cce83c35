"""Sources and sinks: typed CSV load with corrupt lines kept, quarantine reasons, entry()."""

from pyspark.sql import functions as F

from sensorlab.operators import profile
from sensorlab.sources import io
from tests.conftest import SF_SMALL


def test_csv_corrupt_line_is_quarantined(spark, tmp_path):
    p = tmp_path / "sensor.csv"
    p.write_text(
        "udi,product_id,machine_type,air_temperature_k,process_temperature_k,rotational_speed_rpm,"
        "torque_nm,tool_wear_min,target,failure_type\n"
        "1,M14860,M,298.1,308.6,1551,42.8,0,0,No Failure\n"
        "2,L47181,L,298.2,308.7,not_a_number,46.3,3,0,No Failure\n"
        "3,L47182,X,298.1,308.5,1498,49.4,5,1,Power Failure\n"
        "3,L47183,L,298.1,308.5,1498,-1.0,5,0,No Failure\n")
    df = io.load_csv(spark, str(p))
    valid, rejected = io.split_valid(df)
    assert valid.count() == 1
    reasons = {r["udi"]: r["reject_reasons"] for r in rejected.collect()}
    assert "unparsed_line" in reasons[2]
    assert set(reasons) == {2, 3}
    both = [r["reject_reasons"] for r in rejected.where("udi = 3").collect()]
    assert any("machine_type_check" in x for x in both) and any("torque_nm_check" in x for x in both)
    assert all("udi_primary_key" in x for x in both)


def test_describe_approx_close_to_exact(spark):
    df = spark.range(0, 5000).select((F.col("id") % 997).cast("double").alias("v"))
    ex = profile.describe_numeric(df, ["v"]).first()
    ap = profile.describe_numeric(df, ["v"], approx=True).first()
    for q in ("q25", "q50", "q75"):
        assert abs(ex[q] - ap[q]) <= 2.0


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert [f.name for f in df.schema.fields] == ["wear_category", "total_records", "failures",
                                                  "failure_rate_percentage"]
    assert sum(r["total_records"] for r in rows) == 1000
