from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemill.functions import with_ingest_ts
from tidemill.operators.maintenance import drop_old_versions
from tidemill.plans import learning
from tidemill.plans.catalog import Shop
from tidemill.plans.frames import NOW
from tidemill.session import run_dir, shared_dir
from tidemill.sinks import overwrite_partitions, replace_table
from tidemill.sources import read_layer

SF = "/root/testdata/sf0.001"


def test_recommendations_flow(spark, folder):
    assert learning.refresh_recommendations(spark, folder, NOW) is None
    overwrite_partitions(Shop(spark, SF).purchases(), folder, "silver", "purchases_enriched")
    report = learning.refresh_recommendations(spark, folder, NOW)
    stored = read_layer(spark, folder, "serving", "user_recommendations")
    per_user = stored.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("item_id").alias("d"))
    assert report.rows == stored.count() > 0 and per_user.where("n > 10 or n <> d").count() == 0
    assert read_layer(spark, folder, "features", "model_quality").first().rmse > 0


def test_embeddings_are_made_once(spark, folder):
    reviews = Shop(spark, SF).frame("reviews").select("review_id", "review")
    half = reviews.where("review_id < 100")
    first = learning.refresh_embeddings(spark, folder, half)
    second = learning.refresh_embeddings(spark, folder, reviews)
    assert first.rows == half.count() and second.rows == reviews.count() - half.count()
    assert learning.refresh_embeddings(spark, folder, reviews).rows == 0
    stored = read_layer(spark, folder, "serving", "review_vectors")
    assert stored.select("review_id").distinct().count() == stored.count() == reviews.count()


def test_old_versions_are_dropped(spark, folder):
    for n in range(4):
        replace_table(spark.range(n), folder, "gold", "t")
    assert [p[-1] for p in drop_old_versions(spark, folder, "gold", "t")] == ["0", "1"]
    assert read_layer(spark, folder, "gold", "t").count() == 3
    with pytest.raises(ValueError):
        drop_old_versions(spark, folder, "gold", "t", keep=0)


def test_shared_folder_is_the_session_s(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_ingest_time(spark):
    assert rows(with_ingest_ts(spark.range(1), NOW)) == [(0, NOW)]
