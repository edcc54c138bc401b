from pyspark.sql import functions as F

from crowdscope.functions import columns as C
from crowdscope.functions.taxonomy import NEWS_TAXONOMY
from crowdscope.operators.reshape import list_columns, list_explode

URL_CASES = [
    ("http://a.com/Sports/cricket/x/y.cms", "sports", "cricket"),
    ("https://a.com/sports/cricket/x", "a.com", "sports"),
    ("http://a.com/sports/cricket", "sports", ""),
    ("http://a.com/sports/", "sports", ""),
    ("http://a.com/sports", "", "http:"),
    ("http://a.com/", "", "http:"),
    ("http://a.com", "http:", ""),
    ("a.com/sports/cricket/x", "cricket", ""),
    ("x", "", ""),
    ("", "", ""),
    (None, None, None),
]


def sections_model(u):
    """Plain-Python statement of the section rule, by slash positions
    (1-based): ``late`` is the first slash at character 8 or later."""
    if u is None:
        return None, None
    slashes = [i + 1 for i, ch in enumerate(u) if ch == "/"]
    after = lambda p: next((q for q in slashes if q > p), 0)
    between = lambda p, q: u[p:q - 1]                  # text strictly between positions p and q
    first = slashes[0] if slashes else 0
    late = next((q for q in slashes if q >= 8), 0)
    if late:
        nxt = after(late)
        if nxt:
            third = after(nxt)
            s1, s2 = between(late, nxt), (between(nxt, third) if third else "")
        else:
            s1, s2 = "", u[:first - 1]
    else:
        s1 = u[:first - 1] if first else ""
        second = after(first) if first else 0
        s2 = between(first, second) if first and second else ""
    return s1.strip(" ").lower(), s2.strip(" ").lower()


def test_url_sections_literal_cases(spark):
    df = spark.createDataFrame([(u,) for u, _, _ in URL_CASES], "u string")
    s1, s2 = C.url_sections("u")
    got = {r.u: (r.a, r.b) for r in df.select("u", s1.alias("a"), s2.alias("b")).collect()}
    for u, a, b in URL_CASES:
        assert got[u] == (a, b), u


def test_url_sections_match_model_on_pages_and_random_text(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    pages = [r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").collect()]
    s1, s2 = C.url_sections("u")

    def check(urls):
        df = spark.createDataFrame([(u,) for u in urls], "u string")
        for r in df.select("u", s1.alias("a"), s2.alias("b")).collect():
            assert (r.a, r.b) == sections_model(r.u), r.u

    check(pages + [u for u, _, _ in URL_CASES])

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.text(alphabet="/:ab.h ", max_size=24), min_size=50, max_size=50))
    def random_batches(urls):
        check(urls)

    random_batches()


def test_url_sections_fixed_mode(spark):
    df = spark.createDataFrame([("https://a.com/Sports/cricket/x?y=1",), ("http://a.com",), (None,)], "u string")
    s1, s2 = C.url_sections("u", fixed=True)
    got = [tuple(r) for r in df.select(s1, s2).collect()]
    assert got == [("sports", "cricket"), ("", ""), (None, None)]


def test_device_key_and_brand(spark):
    cases = [("samsung/Samsung SM-J7", "SAMSUNG SM-J7", "SAMSUNG"), ("xiaomi/redmi 3", "XIAOMI REDMI 3", "XIAOMI"),
             ("noslash", "NOSLASH", ""), ("/x", "X", ""), ("a/b/c", "A B/C", "A"), (None, None, None),
             ("  lg/ g4 ", "LG  G4", "LG")]
    df = spark.createDataFrame([(d,) for d, _, _ in cases], "d string")
    got = df.select("d", C.device_key("d").alias("k"), C.device_brand("d").alias("b")).collect()
    exp = {d: (k, b) for d, k, b in cases}
    for r in got:
        assert (r.k, r.b) == exp[r.d], r.d


def test_install_weekday(spark):
    df = spark.createDataFrame([("27-04-2017",), ("x",), (None,)], "d string")
    got = [r[0] for r in df.select(C.install_weekday("d")).collect()]
    assert got == ["Thursday", None, None]


def test_list_items_and_explode(spark):
    many = ",".join(f"c{i}" for i in range(31))
    df = spark.createDataFrame([(1, "a,b,"), (2, ""), (3, None), (4, many)], "uid int, l string")
    ex = list_explode(df, ["uid"], "l", 30)
    rows = {}
    for r in ex.collect():
        rows.setdefault(r.uid, []).append((r.pos, r.value))
    assert sorted(rows[1]) == [(0, "a"), (1, "b"), (2, "")]
    assert rows[2] == [(0, "")]
    assert 3 not in rows
    assert len(rows[4]) == 30 and max(p for p, _ in rows[4]) == 29
    cols = list_columns(df, ["uid"], "l", 30).filter("uid = 1").first()
    assert (cols.col1, cols.col2, cols.col3, cols.col4, cols.col30) == ("a", "b", "", None, None)


def test_taxonomy_on_literal_urls(spark):
    from crowdscope.plans.tagging import category_shares
    urls = ["http://x.com/horoscope/a/1", "http://x.com/sports/cricket/1", "http://x.com/economy/business/1",
            "http://x.com/punjab/x/1", "http://x.com/a/ifestyle/1", None]
    ev = spark.createDataFrame([("u", "read", u) for u in urls], "uid string, mevent string, aurl string")
    r = category_shares(ev, NEWS_TAXONOMY).first().asDict()
    assert r["tot_readevent"] == 6
    assert r["astrology"] == 1 / 6
    assert r["sports"] == 1 / 6            # both sections match: counted once
    assert r["business"] == 1 / 6
    assert r["regional"] == 1 / 6
    assert r["lifestyle"] == 1 / 6
    assert r["spirituaity"] == 0.0
    assert [c.name for c in NEWS_TAXONOMY][13] == "spirituaity"


def test_null_uid_kept_in_shares_dropped_from_tags(spark):
    from crowdscope.plans.tagging import category_shares, interest_tags
    rows = [(None, "read", "http://x.com/sports/a/1")] * 5 + [("u", "read", "http://x.com/sports/a/1")] * 5
    ev = spark.createDataFrame(rows, "uid string, mevent string, aurl string")
    shares = {r.uid: r.sports for r in category_shares(ev).collect()}
    assert shares == {None: 1.0, "u": 1.0}
    tags = interest_tags(ev, "2024-05-01").collect()
    assert [(t.uid, t.pref_catg, t.month, t.year, t.tot_readevent) for t in tags] == [("u", "sports", 5, 2024, 5)]


def device_key_model(d):
    if d is None:
        return None
    u = d.strip(" ").upper()
    if "/" not in u:
        return u
    brand, model = u.split("/", 1)
    return model if brand in model else f"{brand} {model}"


def test_device_key_matches_model_on_random_text(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    key = C.device_key("d")

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.one_of(st.none(), st.text(alphabet="ab/ A", max_size=12)), min_size=40, max_size=40))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "d string")
        for r in df.select("d", key.alias("k")).collect():
            assert r.k == device_key_model(r.d), r.d

    check()


def test_crosstab_counts_named_values_and_nulls(spark):
    from crowdscope.operators.aggregates import crosstab, crosstab_counts
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), (None, "y"), ("b", "z")], "k string, v string")
    wide = {tuple(r) for r in crosstab(df, "k", "v", ["x", "y"]).collect()}
    assert wide == {("a", 2, 0), ("b", 0, 0), ("null", 0, 1)}
    long = {tuple(r) for r in crosstab_counts(df, "k", "v").collect()}
    assert long == {("a", "x", 2), ("a", None, 1), (None, "y", 1), ("b", "z", 1)}


def test_row_ids_hold_their_time(spark):
    from crowdscope.plans.tagging import row_id_millis, with_row_ids
    rows = with_row_ids(spark.range(500)).select(
        "createdtime", (row_id_millis(F.col("createdtime")) == F.unix_millis("created_at")).alias("same")).collect()
    assert all(r.same for r in rows) and len({r.createdtime for r in rows}) == 500
