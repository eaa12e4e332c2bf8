import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from rankweave.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


# id, description, country, variety, color, price, points, embedding
ITEMS = [
    (0, "Ripe cherry and leather, dry finish.", "France", "Malbec", "red", 20.0, 91, [1.0, 0.0]),
    (1, "Cherry cherry cherry", "Italy", "Barbera", "red", None, 88, [0.0, 1.0]),
    (2, "Crisp green apple; rosé colour", "France", "Rosé", "rose", 0.0, 85, [0.6, 0.8]),
    (3, "", "Italy", None, None, 12.5, 95, [0.8, 0.6]),
    (4, None, None, "Malbec", "red", 20.0, 80, None),
    (5, "Ripe cherry and leather, dry finish.", "France", "Malbec", "red", 35.0, 91, [1.0, 0.0]),
    (6, "Apple and leather", "Spain", "Albariño", "white", 15.0, 90, [-1.0, 0.0]),
]
ITEM_SCHEMA = (
    "doc_id long, description string, country string, variety string, color string, price double, "
    "points long, embedding array<float>"
)
QUERY_SCHEMA = (
    "query_id long, query string, qv array<float>, f_country string, f_variety string, f_color string, "
    "f_price_min double, f_price_max double, f_points_min double, f_points_max double"
)


def query(i, text, qv=(1.0, 0.0), country=None, variety=None, color=None, lo=None, hi=None, pmin=None, pmax=None):
    return (i, text, None if qv is None else list(qv), country, variety, color, lo, hi, pmin, pmax)


QUERIES = [
    query(0, "cherry leather"),
    query(1, "cherry", country="France"),
    query(2, "apple", country="", hi=20.0),
    query(3, "zinc", lo=0.0),
    query(4, "leather", pmin=1000.0),
    query(5, "???", color="red", pmin=88.0, pmax=91.0),
    query(6, "ripe apple", qv=None),
    query(7, "cherry", qv=(0.6, 0.8), variety="Malbec", lo=20.0, hi=20.0),
]


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame(ITEMS, ITEM_SCHEMA)


@pytest.fixture(scope="session")
def queries(spark):
    return spark.createDataFrame(QUERIES, QUERY_SCHEMA)


@pytest.fixture(scope="session")
def catalogue(items):
    from rankweave.sources.catalogue import build_catalogue

    return build_catalogue(items, 4)


def passes(item, q):
    """The filter rules, restated for single Python rows."""
    _, _, country, variety, color, price, points, _ = item
    _, _, _, f_country, f_variety, f_color, lo, hi, pmin, pmax = q
    for value, wanted in ((country, f_country), (variety, f_variety), (color, f_color)):
        if wanted and value != wanted:
            return False
    for value, low, high in ((price, lo, hi), (points, pmin, pmax)):
        if low is not None and (value is None or value < low):
            return False
        if high is not None and (value is None or value > high):
            return False
    return True


def ranked(frame, *columns):
    """query_id -> rows in rank order."""
    out = {}
    for row in frame.orderBy("query_id", "rank").collect():
        out.setdefault(row["query_id"], []).append(tuple(row[c] for c in columns))
    return out
