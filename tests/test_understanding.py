"""Rule extraction: the golden set, its quirks, reuse of repeats, fallback and display."""

import pytest
from pyspark.sql import functions as F

from rankweave.operators import present, understand

# query, country, variety, color, price_max, points_min as the rules give them
GOLDEN = [
    ("earthy notes of leather and dried cherry", None, None, None, None, None),
    ("something crisp and refreshing for a hot afternoon", None, None, None, None, None),
    ("big tannic wine to pair with steak", None, None, None, None, None),
    ("elegant and mineral driven with high acidity", None, None, None, None, None),
    ("French red wine", "France", None, "red", None, None),
    ("Italian white", "Italy", None, "white", None, None),
    ("a bottle from Argentina", "Argentina", None, None, None, None),
    ("sparkling wine", None, None, "sparkling", None, None),
    ("California Chardonnay with oak and butter", "US", "Chardonnay", "white", None, None),
    ("Spanish red under $30", "Spain", None, "red", 30, None),
    ("German Riesling with racy acidity", "Germany", "Riesling", "white", None, None),
    ("Oregon Pinot Noir, 90 points or better", "US", "Pinot Noir", "red", None, 90),
    ("cheap Italian red under $20, 90+ points", "Italy", None, "red", 20, 90),
    ("Bordeaux-style red blend under $25 rated at least 92", None, "Bordeaux-style Red Blend", "red", 25, 92),
    ("outstanding Napa Cabernet Sauvignon over 95 points", "US", "Cabernet Sauvignon", "red", None, 95),
    ("bargain Portuguese red under $15 with 90+ points", "Portugal", "Portuguese Red", "red", 15, 90),
    ("gooseberry and passionfruit Sauvignon Blanc", None, "Sauvignon Blanc", "white", None, None),
    ("brett and barnyard funk", None, None, None, None, None),
    ("petrol note aged Riesling", None, "Riesling", "white", None, None),
    ("chocolate espresso Malbec", None, "Malbec", "red", None, None),
]
REDS = ["Bordeaux-style Red Blend", "Cabernet Sauvignon", "Malbec", "Pinot Noir", "Portuguese Red"]
WHITES = ["Chardonnay", "Riesling", "Sauvignon Blanc"]


@pytest.fixture(scope="module")
def vocabulary(spark):
    countries = ["Argentina", "France", "Germany", "Italy", "Portugal", "Spain", "US"]
    varieties = [*REDS, *WHITES, "Rosé", "Field Blend", "Cabernet"]
    classes = [(v, "red") for v in REDS] + [(v, "white") for v in WHITES] + [("Field Blend", "other")]
    return understand.Vocabulary(
        countries=spark.createDataFrame([(c,) for c in countries], "value string"),
        aliases=understand.pairs_table(spark, understand.COUNTRY_ALIASES, "alias"),
        varieties=spark.createDataFrame([(v, i) for i, v in enumerate(varieties, 1)], "value string, freq_rank int"),
        colors=understand.pairs_table(spark, understand.COLOR_KEYWORDS, "keyword"),
        variety_color=spark.createDataFrame(classes, "variety string, color string"),
    )


def extract(spark, vocabulary, texts):
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")
    rows = understand.extract_by_rules(queries, vocabulary).orderBy("query_id").collect()
    assert [r["query_id"] for r in rows] == list(range(len(texts)))
    return rows


def test_golden_set(spark, vocabulary):
    for row, want in zip(extract(spark, vocabulary, [g[0] for g in GOLDEN]), GOLDEN):
        assert (row["query"], row["country"], row["variety"], row["color"], row["price_max"], row["points_min"]) == want
        assert row["price_min"] is None and row["points_max"] is None


QUIRKS = [
    ("under 90 points", {"price_max": 90.0, "points_min": None}),
    ("under $30 or 20 or less", {"price_max": 20.0}),
    ("$19.99 and under", {"price_max": 99.0}),
    ("under $19.99", {"price_max": 19.0}),
    ("at least 92", {"points_min": None, "price_min": None}),
    ("rated 79", {"points_min": None}),
    ("rated 101 pts, 93 pts or more", {"points_min": 93.0}),
    ("give us a red", {"country": "US", "color": "red"}),
    ("white port", {"color": "white"}),
    ("port and madeira", {"color": "fortified"}),
    ("over $50", {"price_min": 50.0, "price_max": None}),
    ("thunder 30", {"price_max": 30.0}),
    ("from Spain or France", {"country": "France"}),
    ("italian food with a wine from US", {"country": "US"}),
    ("a rosé wine", {"variety": "Rosé", "color": "rose"}),
    ("rosés", {"variety": None, "color": None}),
    ("Cabernet Sauvignon", {"variety": "Cabernet Sauvignon"}),
    ("field blend", {"variety": "Field Blend", "color": None}),
    ("californian's best", {"country": "US"}),
    ("new  zealand", {"country": None}),
    ("orange wine", {"color": "orange"}),
    ("orange-wine", {"color": None}),
    ("red_wine", {"color": None}),
    ("", {"country": None, "price_max": None}),
    ("   ", {"country": None, "query": "   "}),
]


def test_quirks(spark, vocabulary):
    rows = extract(spark, vocabulary, [q for q, _ in QUIRKS])
    for row, (text, want) in zip(rows, QUIRKS):
        assert {k: row[k] for k in want} == want, text


def test_values_that_differ_in_case_only(spark, vocabulary):
    countries = spark.createDataFrame([("Chile",), ("CHILE",)], "value string")
    vocabulary = understand.Vocabulary(countries, *[getattr(vocabulary, n) for n in ("aliases", "varieties", "colors", "variety_color")])
    assert extract(spark, vocabulary, ["red from chile"])[0]["country"] == "Chile"


def test_repeats_are_extracted_once(spark, vocabulary):
    texts = ["French red", "french   RED ", "Italian white", "French red"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")
    seen = []

    def extractor(once):
        seen.append(once.count())
        return understand.extract_by_rules(once, vocabulary)

    rows = understand.extract_once(queries, extractor).orderBy("query_id").collect()
    assert seen == [2]
    assert [r["_source"] for r in rows] == ["llm", "cache", "llm", "cache"]
    assert [r["country"] for r in rows] == ["France", "France", "Italy", "France"]


def test_rules_are_not_served_from_a_cache(spark, vocabulary):
    queries = spark.createDataFrame([(0, "French red"), (1, "french red")], "query_id long, query string")
    rows = understand.extract_once(queries, lambda once: understand.extract_by_rules(once, vocabulary), "rules", None)
    assert [r["_source"] for r in rows.collect()] == ["rules", "rules"]


def test_one_long_phrase_does_not_make_queries_emit_every_length(spark, monkeypatch):
    long = " ".join(f"w{i}" for i in range(500))
    phrases = spark.createDataFrame([("malbec", 0), (long, 1)], "phrase string, priority int")
    queries = spark.createDataFrame([(0, "x malbec y " + long), (1, "w0 w1 w2")], "query_id long, query string")
    sent = []
    join = understand.lookup_join
    monkeypatch.setattr(understand, "lookup_join", lambda large, *rest, **more: sent.append(large) or join(large, *rest, **more))
    found = understand.phrase_matches(queries, phrases)
    assert sorted((r["query_id"], r["priority"]) for r in found.collect()) == [(0, 0), (0, 1)]
    # 503 single words and 4 sequences of 500 words; 3 words of the short text
    assert sent[0].count() == 503 + 4 + 3


def test_tiers_choose_whole_records(spark):
    schema = "query_id long, country string, variety string, color string, price_min double, price_max double, points_min double, points_max double, query string"
    rules = spark.createDataFrame([(i, "R", "rv", None, None, None, None, None, "raw") for i in range(3)], schema)
    model = spark.createDataFrame([(i, None, None, "red", None, None, None, None, "m") for i in (0, 1)], schema)
    cached = spark.createDataFrame([(0, "C", None, None, None, None, None, None, "c")], schema)
    queries = spark.createDataFrame([(i, f"q{i}") for i in range(3)], "query_id long, query string")
    rows = understand.resolve(queries, rules, model, cached).orderBy("query_id").collect()
    assert [(r["_source"], r["country"], r["variety"], r["color"], r["query"]) for r in rows] == [
        ("cache", "C", None, None, "c"), ("llm", None, None, "red", "m"), ("rules", "R", "rv", None, "raw"),
    ]
    bare = understand.resolve(queries, None).first()
    assert (bare["_source"], bare["query"], bare["country"]) == ("raw", "q0", None)


def test_rating_bands(spark):
    points = [100, 98, 97, 94, 90, 87, 83, 80, 79]
    frame = spark.createDataFrame([(p,) for p in points], "p int")
    got = [r[0] for r in frame.select(present.rating_band(F.col("p"))).collect()]
    assert got == ["Classic", "Classic", "Superb", "Superb", "Excellent", "Very Good", "Good", "Acceptable", ""]


def test_general_number(spark):
    values = [20.0, 12.5, 0.0, 1e6, 1234567.0, 0.0001, 0.00001, 112.8625, 12345.65, 1.10, None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in frame.select(present.general_number(F.col("v"))).collect()]
    assert got == [None if v is None else f"{v:g}" for v in values]


def test_filter_line_and_notes(spark):
    frame = spark.createDataFrame(
        [("Italy", None, "red", None, 20.0, 90.0, None, "cherry", "cache"), (None,) * 7 + ("", "llm")],
        "country string, variety string, color string, price_min double, price_max double, points_min double, points_max double, query string, _source string",
    )
    summary = present.filter_summary(F.lit(3), F.lit(100), F.col("query"), F.col("_source"))
    first, second = (r[0].split("\n") for r in frame.select(summary).collect())
    assert first[0] == "**Country:** Italy · **Style:** red · **Max price:** $20 · **Min rating:** 90.0"
    assert first[-1] == "Filters served from cache"
    assert second == ["No hard filters", "3 on keywords, 100 on meaning"]


def test_white_space_of_every_kind(spark):
    from pyspark.sql import functions as F

    from rankweave.functions.text import normalized_key, strip

    row = spark.createDataFrame([("\u00a0\u3000 Red\u2009\u00a0Wine \u2003\x0b",)], "t string").select(
        strip(F.col("t")).alias("s"), normalized_key(F.col("t")).alias("k")
    ).first()
    assert (row["s"], row["k"]) == ("Red\u2009\u00a0Wine", "red wine")
