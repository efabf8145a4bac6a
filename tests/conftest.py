import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finlake.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"}
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SF


def rows(df, *order):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr)


TX_SCHEMA = (
    "id long, conta_id long, tipo_transacao string, valor double, data_transacao timestamp, status string, "
    "aprovada boolean, canal string, cidade string, estado string, score_risco double, tempo_processamento_ms int"
)


def tx(spark, *items):
    """Transactions from (id, conta, tipo, valor, time[, city, status]) tuples."""
    from datetime import datetime

    data = []
    for item in items:
        i, account, kind, value, when, *rest = item
        city = rest[0] if rest else "C1"
        status = rest[1] if len(rest) > 1 else "AUTORIZADA"
        data.append((i, account, kind, value, datetime.fromisoformat(when), status, status == "AUTORIZADA",
                     "MOBILE", city, "SP", 0.2, 10))
    return spark.createDataFrame(data, TX_SCHEMA)
