"""How the feed's documents are built."""

import json

import pytest
from pyspark.sql import functions as F

from workload import feed


@pytest.mark.parametrize("options", [{}, {"rough": True}, {"rough": True, "faults": False}])
def test_events_are_shuffled_as_facts_and_not_as_text(spark, sf_dir, options):
    documents = feed.documents(feed.events(spark, sf_dir), **options)
    plan = documents._jdf.queryExecution().executedPlan().toString()
    _, exchange, below = plan.partition("Exchange hashpartitioning")
    assert exchange
    assert "feed.example" not in below


def test_features_are_in_the_order_of_their_ids_and_then_their_text(spark, sf_dir):
    events = feed.events(spark, sf_dir).where("event_id < 3")
    again = events.withColumn("event_type", F.lit("event_id 'again'"))
    texts = feed.documents(events.unionByName(again)).collect()
    features = [feature for row in texts for feature in json.loads(row["value"])["features"]]
    assert [feature["id"] for feature in features] == ["0", "0", "1", "1", "2", "2"]
    places = [feature["properties"]["place"] for feature in features]
    assert all(first < second for first, second in zip(places[::2], places[1::2]))


def test_only_names_of_facts_are_taken_from_the_event():
    sql = "concat('event_id of ', event_id, ' value', value, event_ids)"
    assert feed._of_event(sql) == "concat('event_id of ', event.event_id, ' value', event.value, event_ids)"
