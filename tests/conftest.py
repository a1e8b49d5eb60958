import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 1)

BASE_CLAIM = {
    "claim_id": "C1", "patient_id": "P1", "age": 40, "sex": "male", "bmi": 27.0, "children": 1, "smoker": False,
    "region": "northeast", "claim_amount": 5000.0, "procedure_code": "99213",
    "procedure_description": "office_visit_moderate", "provider_id": "PRV1000",
    "submission_timestamp": "2023-12-01T10:00:00", "days_since_last_claim": 100, "diagnosis_code": "A01",
    "is_fraud": False,
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_claims(spark):
    """Claims from dicts of the fields that differ from BASE_CLAIM."""
    from claimwright.schema import CLAIM_SCHEMA

    def build(*changes):
        rows = [{**BASE_CLAIM, **change} for change in changes]
        return spark.createDataFrame([tuple(r[f.name] for f in CLAIM_SCHEMA) for r in rows], CLAIM_SCHEMA)

    return build


@pytest.fixture(scope="session")
def features(spark):
    from catalog import inputs

    return inputs.features(spark, SF).cache()
