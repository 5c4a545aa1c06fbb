import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docquarry.session import configure  # noqa: E402
from docquarry.sources.schema import Field, struct_type  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[4]").appName("docquarry-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.maxMetadataStringLength", "5000")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))))
    session = configure(builder.getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


USERS = {
    "_id": Field("keyword"),
    "username": Field("keyword"),
    "email": Field("keyword"),
    "age": Field("integer"),
    "address": Field("object", properties={
        "street": Field("text"), "city": Field("keyword"), "country": Field("keyword")}),
}

PEOPLE = {
    "_id": Field("keyword"),
    "name": Field("keyword"),
    "age": Field("integer"),
    "description": Field("text"),
    "tags": Field("keyword", many=True),
    "createdAt": Field("date"),
    "address": Field("nested", properties={
        "street": Field("text"), "city": Field("keyword"), "country": Field("keyword")}),
}


@pytest.fixture(scope="session")
def users(spark):
    return spark.createDataFrame([
        ("1", "user1", "user1@example.com", 25, ("7 Quay Lane", "New York", "USA")),
        ("2", "user2", "user2@example.com", 30, ("12 Mill Row", "Los Angeles", "USA")),
        ("3", "user3", "user3@example.com", 35, ("3 Fern Way", "Chicago", "USA")),
    ], struct_type(USERS))


@pytest.fixture(scope="session")
def people(spark):
    return spark.createDataFrame([
        ("1", "Mara Voss", 25, "Software Developer", ["developer", "typescript"],
         dt.datetime(2024, 1, 1), [("7 Quay Lane", "New York", "USA")]),
        ("2", "Ilse Brandt", 30, "Data Scientist", ["data", "python"],
         dt.datetime(2024, 1, 15), [("21 Dove Court", "Boston", "USA")]),
        ("3", "Teo Marchetti", 35, "DevOps Engineer", ["devops", "kubernetes"],
         dt.datetime(2024, 2, 1), None),
    ], struct_type(PEOPLE))


def ids(df, key="_id"):
    return sorted(r[key] for r in df.select(key).collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()
