import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import ids, plan_of
from docquarry.functions.analysis import ANALYZERS, STANDARD, Analyzer
from docquarry.functions.fuzzy import max_edits, within
from docquarry.functions.predicates import Fields, bool_, required_matches
from docquarry.functions.values import Unparsable


def test_goldens(users):
    q = Fields(users)
    assert ids(users.where(q.match("username", "user1"))) == ["1"]
    assert ids(users.where(q.term("age", 25))) == ["1"]
    assert ids(users.where(q.range("age", gte=30))) == ["2", "3"]
    assert ids(users.where(q.bool(must=[("age", 25)]))) == ["1"]
    assert ids(users.where(q.bool(must_not=[("age", 25)]))) == ["2", "3"]
    assert ids(users.where(q.bool(should=[("age", 25), ("age", 30)]))) == ["1", "2"]
    assert ids(users.where(q.bool(filter=[("age", 25)]))) == ["1"]
    assert ids(users.where(q.term("address.city.keyword", "Chicago"))) == ["3"]
    assert ids(users.where(q.match("address.street", "QUAY lane", operator="and"))) == ["1"]
    assert ids(users.where(q.bool())) == ["1", "2", "3"]


def test_arrays_match_any_element(people):
    q = Fields(people)
    assert ids(people.where(q.term("tags", "python"))) == ["2"]
    assert ids(people.where(q.terms("tags", ["python", "devops"]))) == ["2", "3"]
    assert ids(people.where(q.prefix("tags", "dev"))) == ["1", "3"]
    assert ids(people.where(q.wildcard("tags", "*script"))) == ["1"]
    assert ids(people.where(q.regexp("tags", "k.*s"))) == ["3"]
    assert ids(people.where(q.fuzzy("tags", "pyhton"))) == ["2"]
    assert ids(people.where(q.exists("address"))) == ["1", "2"]
    assert ids(people.where(q.term("address.city", "Boston"))) == ["2"]
    assert ids(people.where(q.match("address.street", "dove"))) == ["2"]


def test_fuzzy_on_a_keyword_is_whole_value(people):
    q = Fields(people)
    assert ids(people.where(q.fuzzy("name", "Jon"))) == []
    assert ids(people.where(q.fuzzy("name", "Mraa Voss"))) == ["1"]
    assert ids(people.where(q.fuzzy("name", "Mraa Voss", fuzziness=1, transpositions=False))) == []
    assert ids(people.where(q.fuzzy("description", "developr"))) == ["1"]


@pytest.fixture(scope="module")
def baskets(spark):
    return spark.createDataFrame([
        ("both", [("Product A", 10), ("Product B", 1)]),
        ("split", [("Product A", 1), ("Product B", 10)]),
        ("empty", []),
        ("null", None),
        ("null element", [None]),
    ], "_id string, orders array<struct<name:string,quantity:int>>")


def test_nested_ties_conditions_to_one_element(baskets):
    q = Fields(baskets, text=["orders.name"])
    inner = lambda e: e.bool(must=[
        e.match("name", "Product A", operator="AND"), e.range("orders.quantity", gte=10)])
    assert ids(baskets.where(q.nested("orders", inner))) == ["both"]
    loose = q.bool(must=[q.match("orders.name", "Product A", operator="AND"),
                         q.range("orders.quantity", gte=10)])
    assert ids(baskets.where(loose)) == ["both", "split"]
    rest = q.bool(must_not=[q.nested("orders", inner)])
    assert ids(baskets.where(rest)) == ["empty", "null", "null element", "split"]
    assert ids(baskets.where(q.exists("orders"))) == ["both", "split"]


def test_nested_reads_a_single_object(users):
    q = Fields(users)
    assert ids(users.where(q.nested("address", lambda e: e.term("address.city", "Chicago")))) == ["3"]
    with pytest.raises(TypeError):
        q.nested("age", lambda e: e.term("x", 1))


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame([
        ("a", 1, "x", ["p", None]), ("b", None, "", []), ("c", 3, None, [None]), ("d", 4, "y", None),
    ], "_id string, n int, s string, tags array<string>")


def test_null_logic_is_two_valued(gaps):
    q = Fields(gaps)
    for p in [q.term("n", 1), q.range("n", gt=2), q.term("s", "x"), q.term("tags", "p"),
              q.exists("tags"), q.prefix("s", "x"), q.terms("n", [1, 4]), q.fuzzy("s", "xx"),
              q.bool(should=[("n", 1), ("s", "y")], minimum_should_match=1)]:
        hit, miss = ids(gaps.where(p)), ids(gaps.where(bool_(must_not=[p])))
        assert sorted(hit + miss) == ["a", "b", "c", "d"]
        assert not set(hit) & set(miss)


def test_exists(gaps):
    q = Fields(gaps)
    assert ids(gaps.where(q.exists("s"))) == ["a", "b", "d"]
    assert ids(gaps.where(q.exists("tags"))) == ["a"]
    assert ids(gaps.where(q.exists("n"))) == ["a", "c", "d"]


def test_bool_minimum_should_match(gaps):
    q = Fields(gaps)
    should = [("n", 1), ("s", "x"), ("tags", "p"), ("n", {"gte": 1})]
    for need, expected in [(1, "acd"), (2, "a"), (4, "a"), ("-1", "a"), ("25%", "acd"), (5, ""),
                           (0, "abcd")]:
        found = ids(gaps.where(q.bool(should=should, minimum_should_match=need)))
        assert found == list(expected), need
    assert ids(gaps.where(q.bool(filter=[("n", {"gte": 1})], should=[("s", "x")]))) == list("acd")


@pytest.mark.parametrize("spec, clauses, need", [
    (2, 3, 2), (-1, 3, 2), ("75%", 4, 3), ("75%", 3, 2), ("-25%", 4, 3), ("-25%", 3, 3),
    ("2<75%", 2, 2), ("2<75%", 4, 3), ("1<50% 3<-1", 5, 4), (-9, 3, 0)])
def test_required_matches(spec, clauses, need):
    assert required_matches(spec, clauses) == need


def test_clause_reads_ranges_lists_and_terms(people):
    q = Fields(people)
    assert ids(people.where(q.clause("age", {"gt": 25, "lt": 35}))) == ["2"]
    assert ids(people.where(q.clause("age", {"gt": 30}))) == ["3"]
    assert ids(people.where(q.clause("tags", ["data", "devops"]))) == ["2", "3"]
    assert ids(people.where(q.clause("name", "Ilse Brandt"))) == ["2"]
    with pytest.raises(ValueError):
        q.clause("age", None)
    with pytest.raises(ValueError):
        q.clause("age", {"near": 3})
    with pytest.raises(KeyError):
        q.term("unknown", 1)


def test_match_options(people):
    q = Fields(people)
    assert ids(people.where(q.match("description", "software scientist"))) == ["1", "2"]
    assert ids(people.where(q.match("description", "software scientist", operator="AND"))) == []
    assert ids(people.where(q.match("description", "data scientist devops",
                                    minimum_should_match="70%"))) == ["2"]
    assert ids(people.where(q.match("description", "enginer", fuzziness="AUTO"))) == ["3"]
    assert ids(people.where(q.match("description", "...", zero_terms_query="all"))) == ["1", "2", "3"]
    assert ids(people.where(q.match("description", "..."))) == []
    assert ids(people.where(q.match("age", "30"))) == ["2"]
    assert ids(people.where(q.match("age", "thirty", lenient=True))) == []
    with pytest.raises(Unparsable):
        q.match("age", "thirty")
    # The query is analysed on its own: a keyword analyzer keeps the case, and no token has it.
    assert ids(people.where(q.match("description", "Software", analyzer="keyword"))) == []


def test_term_on_text_is_a_token(people):
    q = Fields(people)
    assert ids(people.where(q.term("description", "software"))) == ["1"]
    assert ids(people.where(q.term("description", "Software"))) == []
    assert ids(people.where(q.term("description", "Software", case_insensitive=True))) == ["1"]
    assert ids(people.where(q.term("description", "software developer"))) == []
    assert ids(people.where(q.term("name", "mara voss", case_insensitive=True))) == ["1"]


def test_wildcard_escapes(spark):
    df = spark.createDataFrame([("a%b",), ("axb",), ("a_b",), ("a*b",), ("a\\b",)], "_id string")
    q = Fields(df)
    assert ids(df.where(q.wildcard("_id", "a%b"))) == ["a%b"]
    assert ids(df.where(q.wildcard("_id", "a_b"))) == ["a_b"]
    assert ids(df.where(q.wildcard("_id", "a\\*b"))) == ["a*b"]
    assert ids(df.where(q.wildcard("_id", "a\\\\b"))) == ["a\\b"]
    assert len(ids(df.where(q.wildcard("_id", "A?B", case_insensitive=True)))) == 5


def test_dates(people):
    q = Fields(people)
    assert ids(people.where(q.range("createdAt", gte="2024-01-15"))) == ["2", "3"]
    assert ids(people.where(q.range("createdAt", gt=dt.date(2024, 1, 15)))) == ["3"]
    assert ids(people.where(q.range("createdAt", lt="2024-01"))) == []
    assert ids(people.where(q.range("createdAt", lte="15/01/2024", format="dd/MM/yyyy"))) == ["1", "2"]
    assert ids(people.where(q.range("createdAt", gte="1705276800000", format="epoch_millis"))) == ["2", "3"]
    assert ids(people.where(q.range("createdAt", gte=1705276800000))) == ["2", "3"]
    # Midnight in New York is five o'clock in UTC.
    assert ids(people.where(q.range("createdAt", gte="2024-01-15",
                                    time_zone="America/New_York"))) == ["3"]
    assert ids(people.where(q.range("createdAt", gte="2024-01-14T19:00:00-05:00"))) == ["2", "3"]


def test_range_relations(spark):
    df = spark.createDataFrame([("in", (3, 4)), ("over", (1, 9)), ("left", (0, 3)), ("out", (8, 9)),
                                ("open", (4, None)), ("null", None)],
                               "_id string, r struct<gte:int,lte:int>")
    q = Fields(df)
    assert ids(df.where(q.range("r", gte=2, lte=5))) == ["in", "left", "open", "over"]
    assert ids(df.where(q.range("r", gte=2, lte=5, relation="WITHIN"))) == ["in"]
    assert ids(df.where(q.range("r", gte=2, lte=5, relation="CONTAINS"))) == ["over"]
    assert ids(df.where(q.range("r", gt=3, lt=8))) == ["in", "open", "over"]
    with pytest.raises(ValueError):
        q.range("r", gte=1, relation="NEAR")


def test_geo(spark):
    df = spark.createDataFrame([
        ("sf", (37.7749, -122.4194)), ("oakland", (37.8044, -122.2712)), ("la", (34.05, -118.24)),
        ("fiji", (-17.7, 178.0)), ("samoa", (-13.8, -171.8)), ("pole", (89.9, 10.0)), ("null", None),
    ], "_id string, location struct<lat:double,lon:double>")
    q = Fields(df)
    near = q.geo_distance("location", distance="20km", lat=37.7749, lon=-122.4194)
    assert ids(df.where(near)) == ["oakland", "sf"]
    assert ids(df.where(q.geo_distance("location", distance="5mi", lat=37.7749, lon=-122.4194))) == ["sf"]
    assert ids(df.where(q.geo_distance("location", distance="1500km", lat=-16, lon=-178))) == ["fiji", "samoa"]
    assert ids(df.where(q.geo_distance("location", distance="100km", lat=89.9, lon=-170))) == ["pole"]
    assert ids(df.where(q.geo_bounding_box("location", top_left={"lat": 38, "lon": -123},
                                           bottom_right={"lat": 37, "lon": -122}))) == ["oakland", "sf"]
    assert ids(df.where(q.geo_bounding_box("location", top_left={"lat": 0, "lon": 170},
                                           bottom_right={"lat": -20, "lon": -170}))) == ["fiji", "samoa"]
    with pytest.raises(ValueError):
        q.geo_distance("location", distance="5 parsecs", lat=0, lon=0)


def test_geo_box_never_loses_points(spark):
    """The pushable box around a circle is a pure prefilter."""
    rng = random.Random(7)
    rows = [(str(i), (rng.uniform(-90, 90), rng.uniform(-180, 180))) for i in range(400)]
    df = spark.createDataFrame(rows, "_id string, location struct<lat:double,lon:double>").cache()
    q = Fields(df)
    from docquarry.functions.geo import haversine_km
    for lat, lon, km in [(0, 0, 3000), (60, 179, 2500), (-85, 20, 1500), (45, -179.5, 9000), (10, 100, 19000)]:
        exact = haversine_km(F.col("location.lat"), F.col("location.lon"), lat, lon) <= km
        assert ids(df.where(q.geo_distance("location", distance=f"{km}km", lat=lat, lon=lon))) == ids(df.where(exact))


def osa(a, b):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_fuzzy_equals_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(0, 7))) for _ in range(1500)]
    df = spark.createDataFrame([(w,) for w in words], "w string").cache()
    q, tokens = Fields(df), Fields(df, text=["w"])
    for target, k in [("abc", 1), ("abca", 2), ("ca", 2), ("aabbcc", 2), ("bcaé", 1), ("éa", 1)]:
        expected = sorted(w for w in words if osa(w, target) <= k)
        for scope in (q, tokens):
            found = ids(df.where(scope.fuzzy("w", target, fuzziness=k)), "w")
            # An empty value has no token.
            assert found == [w for w in expected if w or scope is q]
        kept = ids(df.where(q.fuzzy("w", target, fuzziness=k, prefix_length=1)), "w")
        assert kept == sorted(w for w in words if w[:1] == target[:1]
                              and osa(w[1:], target[1:]) <= k)


def test_fuzzy_distances(spark):
    pairs = [("jonh", "john", 1), ("acb", "abc", 1), ("sitting", "kitten", 3), ("abc", "ca", 3)]
    for text, word, distance in pairs:
        df = spark.createDataFrame([(text,)], "w string")
        for k in (1, 2):
            assert bool(df.where(Fields(df).fuzzy("w", word, fuzziness=k)).count()) == (distance <= k)


def test_auto_fuzziness():
    assert [max_edits("AUTO", w) for w in ("ab", "abc", "abcde", "abcdef")] == [0, 1, 1, 2]
    assert max_edits("AUTO:4,8", "abc") == 0
    for bad in (3, -1, "lots"):
        with pytest.raises(ValueError):
            max_edits(bad, "word")


@pytest.mark.parametrize("word,prefix", [("abcd", 0), ("ba", 0), ("abcabd", 2), ("dcba", 1), ("a", 0)])
def test_within_is_the_distance(spark, word, prefix):
    rng = random.Random(word)
    others = list({"".join(rng.choice("abcd") for _ in range(rng.randrange(9))) for _ in range(300)})
    df = spark.createDataFrame([(o,) for o in others], "o string")
    for k in (1, 2):
        for swaps in (True, False):
            got = {r.o for r in df.where(within(F.col("o"), word, k, prefix, swaps)).collect()}
            near = osa if swaps else levenshtein
            assert got == {o for o in others if o[:prefix] == word[:prefix] and near(word[prefix:], o[prefix:]) <= k}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, above = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[j] + 1, above[j + 1] + 1, above[j] + (x != y)))
    return row[-1]


def test_long_values(spark):
    word = "ab" * 400
    df = spark.createDataFrame([(word,), ("ba" + word[2:],), (word[1:],), (word[3:],), (None,)], "o string")
    q = Fields(df)
    assert df.where(q.fuzzy("o", word, fuzziness=1)).count() == 3
    assert df.where(q.fuzzy("o", word, fuzziness=1, transpositions=False)).count() == 2


def test_edits_anywhere_in_long_values(spark):
    rng = random.Random(11)
    word = "".join(rng.choice("abü") for _ in range(70))

    def edited(text, times):
        for _ in range(times):
            i, kind = rng.randrange(len(text)), rng.randrange(4)
            text = {0: text[:i] + text[i + 1:], 1: text[:i] + rng.choice("abü") + text[i:],
                    2: text[:i] + rng.choice("abü") + text[i + 1:],
                    3: text[:i] + text[i:i + 2][::-1] + text[i + 2:]}[kind]
        return text

    others = list({edited(word, rng.randrange(5)) for _ in range(400)})
    df = spark.createDataFrame([(o,) for o in others], "o string").cache()
    for k in (1, 2):
        for swaps, near in ((True, osa), (False, levenshtein)):
            found = ids(df.where(Fields(df).fuzzy("o", word, fuzziness=k, transpositions=swaps)), "o")
            assert found == sorted(o for o in others if near(o, word) <= k)


TEXTS = ["The quick-brown fox", "naïve café_42 ÜBER", "", "a  b", "don't stop", "東京 2020!", None,
         "the the THE", "foo_bar foo"]


def test_driver_and_column_analysis_agree(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    for name, rule in [*ANALYZERS.items(), ("custom", Analyzer().with_stop_words(["fox", "the"]))]:
        for row in df.select("i", rule.tokens(F.col("t")).alias("w")).collect():
            if TEXTS[row.i] is None:
                assert row.w is None
            else:
                assert [w for w in row.w if w] == rule.split(TEXTS[row.i]), name


def test_word_search_equals_token_equality(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    for word in ["the", "foo", "bar", "foo_bar", "t", "42", "café_42", "über", "東京", "don't"]:
        by_token = F.array_contains(STANDARD.tokens(F.col("t")), word)
        assert ids(df.where(STANDARD.has_any(F.col("t"), [word])), "i") == ids(df.where(by_token), "i")


def test_stop_words_are_no_tokens(spark):
    df = spark.createDataFrame([("1", "the cat"), ("2", "then cats")], "_id string, t string")
    q = Fields(df, text={"t": "stop"})
    assert ids(df.where(q.match("t", "the cat"))) == ["1"]
    assert ids(df.where(q.prefix("t", "the"))) == []
    assert ids(df.where(q.term("t", "the"))) == []
    assert ids(df.where(q.fuzzy("t", "thn", fuzziness=1))) == []


def test_filters_reach_the_reader(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    q = Fields(orders)
    plan = plan_of(orders.where(q.bool(
        must=[("o_orderstatus", "F"), ("o_orderdate", {"gte": "1996-01-01"})],
        filter=[("o_totalprice", {"gte": 1000}), q.prefix("o_orderpriority", "1")])))
    for pushed in ("EqualTo(o_orderstatus,F)", "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)",
                   "GreaterThanOrEqual(o_totalprice,1000.0)", "StringStartsWith(o_orderpriority,1)"):
        assert pushed in plan
    boxes = orders.select(F.struct(F.col("o_totalprice").alias("lat"),
                                   F.col("o_totalprice").alias("lon")).alias("p"))
    near = Fields(boxes).geo_distance("p", distance="1km", lat=1, lon=1)
    assert "GreaterThanOrEqual(o_totalprice" in plan_of(boxes.where(near))
