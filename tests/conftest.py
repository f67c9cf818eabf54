import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txguard import workspace  # noqa: E402
from txguard.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[4]", 4, spark__ui__enabled="false", spark__driver__memory="4g",
        spark__checkpoint__dir=f"file://{shared}/checkpoints", spark__sql__warehouse__dir=f"file://{shared}/warehouse")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    workspace.clean(session)
    session.stop()


@pytest.fixture
def tx(spark):
    """Builds transactions from dicts; what is left out is a plain payment."""
    from txguard.schema import TX_SCHEMA

    plain = {
        "step": 1, "type": "PAYMENT", "amount": 10.0, "nameOrig": "C1000001", "oldbalanceOrg": 100.0,
        "newbalanceOrig": 90.0, "nameDest": "C2000001", "oldbalanceDest": 0.0, "newbalanceDest": 10.0,
        "isFraud": 0, "isFlaggedFraud": 0,
    }

    def build(*rows):
        return spark.createDataFrame([tuple({**plain, **r}[c] for c in TX_SCHEMA.names) for r in rows], TX_SCHEMA)

    return build


def accounts(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "account string")
