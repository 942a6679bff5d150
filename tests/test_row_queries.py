"""The queries whose rows have no SQL form."""

import numpy as np

import __spark_entry__
from hubbub.functions.constants import CONTENT_FEATURES
from hubbub.plans import queries_recommend
from hubbub.plans.sample_views import Views

SF_DIR = "/root/testdata/sf0.001"


def rows(spark, name):
    return __spark_entry__.queries()[name](spark, SF_DIR)


def test_models_have_their_coefficients(spark):
    training = queries_recommend._country_training(Views(spark, SF_DIR)).toPandas()
    found = rows(spark, "country_model_rows").collect()
    assert len(found) == training["country_code"].nunique() > 0
    for r in found:
        own = training[training["country_code"] == r.account]
        x, y = own[list(CONTENT_FEATURES)].to_numpy(float), own["label"].to_numpy(float)
        b = np.array(r.coefficients)
        x0, y0 = x - x.mean(axis=0), y - y.mean()
        rest = x0.T @ (y0 - x0 @ b) / len(y) - 0.1 * x.var(axis=0) * b
        assert np.abs(rest / (x.std(axis=0) * y.std() + 1e-9)).max() < 1e-5 and r.residual < 1e-5
        assert abs(r.intercept - (y.mean() - x.mean(axis=0) @ b)) < 1e-6 * (1 + abs(r.intercept))


def test_recommendations_and_classes_are_rows(spark):
    got = rows(spark, "member_recommendation_rows").toPandas()
    assert list(got.columns) == ["person_id", "content_id", "score"] and not got.isna().any().any()
    assert not got.duplicated(["person_id", "content_id"]).any() and got.groupby("person_id").size().max() <= 10
    classes = rows(spark, "user_cluster_rows").toPandas()
    assert classes["user_id"].is_unique and classes["user_class"].nunique() > 1


def test_account_models_have_their_coefficients(spark):
    found = rows(spark, "account_model_rows").collect()
    assert found and all(len(r.coefficients) == len(CONTENT_FEATURES) and r.residual < 1e-5 for r in found)


def test_topics_and_bent_recommendations_are_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").toPandas()
    tagged = rows(spark, "text_topic_rows").toPandas().merge(docs, on="doc_id")
    assert len(tagged) == len(docs) and (tagged["class"] == "etc").equals(tagged["score"] == 0)
    known = tagged[(tagged["class"] != "etc") & tagged["lang"].notna()]
    # Words tell the language of a text, whatever else they say.
    assert len(known) > len(docs) / 2 and (known["class"].str.split("-").str[0] == known["lang"]).mean() > 0.8
    got = rows(spark, "autoencoder_recommendation_rows").toPandas()
    assert not got.isna().any().any() and got["score"].between(0, 1).all()
    assert not got.duplicated(["person_id", "content_id"]).any() and got.groupby("person_id").size().max() <= 10
