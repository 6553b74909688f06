import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from patronage.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "patronage-tests", "6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def stored_log(spark):
    from patronage.sources.retail_log import transaction_log
    from patronage.sources.storage import materialise
    return materialise(transaction_log(spark, SF), "test-log")


@pytest.fixture(scope="session")
def stored_mart(spark, stored_log):
    from patronage.operators.clean import clean
    from patronage.operators.scoring import customer_rfml
    from patronage.operators.warehouse import renamed
    from patronage.sources.storage import materialise
    return materialise(customer_rfml(renamed(clean(stored_log))), "test-mart")
