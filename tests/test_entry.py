import __spark_entry__ as entry_mod


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"user_id", "obs_date", "epi_year", "epi_week", "has_error"} <= set(df.columns)
    assert df.schema == entry_mod.entry(spark).schema  # stable schema
