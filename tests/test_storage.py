

def test_a_leap_day_expires_with_28_february(spark):
    from ticksmith.plans.storage import retain
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-02-29 12:00:00' AS inserted_at")
    assert retain(df, "2026-02-28 13:00:00").count() == 0
    assert retain(df, "2026-02-28 11:00:00").count() == 1
