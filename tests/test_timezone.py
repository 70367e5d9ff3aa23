"""Results do not depend on the session time zone (timestamps are TIMESTAMP_NTZ end to end)."""
from conftest import SF
import __spark_entry__ as E


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_session_time_zone_does_not_shift_results(spark):
    q = E.queries()
    names = ["check_register", "delimited_lines", "mark_printed", "unlock_outcome"]
    base = {n: _rows(q[n](spark, SF)) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            for n in names:
                assert _rows(q[n](spark, SF)) == base[n], (tz, n)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
