"""Addresses read alike however they are spelled."""

from pyspark.sql import functions as F

from jobstrata.llm.addresses import posting_key, url_parts


def test_posting_keys_are_equal_however_spelled(spark):
    same = ["https://boards.x.example/acme/jobs/123456789", "HTTPS://www.Boards.X.Example:443//acme/jobs/123456789/apply/?utm_source=a&ref=b#apply",
            "//boards.x.example/acme/jobs/12345678%39;jsessionid=AB12", " http://boards.x.example/acme/jobs/123456789\t",
            "https://go.relay.example/out?to=https%3A%2F%2Fboards.x.example%2Facme%2Fjobs%2F12345678%2539"]
    other = ["https://boards.x.example/acme/jobs/123456780", "https://boards.x.example/beta/jobs/123456789", "https://boards.x.example/acme", "", None,
             "https://careers.acme.example/students", "100%", "https://x.example/a%zz/12345"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(same + other)], "i int, url string")
    got = [r.k for r in url_parts(df, "url").select("i", posting_key(F.col("_host"), F.col("_path"), F.col("_query")).alias("k")).orderBy("i").collect()]
    assert len(set(got[:5])) == 1 and got[0] is not None
    assert got[5] and got[6] and len({got[0], got[5], got[6]}) == 3
    assert got[7:12] == [None, None, None, None, None] and got[12] is not None
