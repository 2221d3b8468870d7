from fleetgauge.llm import urls


def test_rank_reaches_the_end_of_a_long_chain(spark):
    """Hosts more than 50 links from the seed get their rank too."""
    links = spark.createDataFrame([(f"h{k}", f"h{k + 1}", 1) for k in range(54)], "source string, target string, weight long")
    got = {r.host: r["rank"] for r in urls.spread(links, spark.createDataFrame([("h0", 1.0)], "host string, seed double")).collect()}
    assert all(abs(got[f"h{k}"] - 0.15 * 0.85**k) < 1e-6 and got[f"h{k}"] > 0 for k in range(54))
