"""Matching against brute force over all pairs, with a name and an address shared by a third of the records."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crosswalk.operators import match as M
from crosswalk.operators import recent as R
from crosswalk.plans import resolution

W = M.WEIGHTS


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(3)
    data = []
    for i in range(240):
        hot = i % 3 == 0
        data.append((
            i, "john" if hot else rng.choice(["amy", "bob", None, "cy"]), "smith" if hot else rng.choice(["lee", "ray", "fox"]), rng.choice([None, "a@x", "b@x", "c@x", f"u{i}@x"]),
            rng.choice([None, "1", "2", str(i)]), rng.choice(["s1", "s2", "s3"]),
        ))
    return spark.createDataFrame(data, "id int, first_name string, last_name string, email string, phone string, site string").cache()


@pytest.fixture(scope="module")
def scores(people):
    """{(a, b): (score, matched fields)} over all ordered pairs that share a field."""
    recs = [r.asDict() for r in people.collect()]
    out = {}
    for a in recs:
        for b in recs:
            if a["id"] != b["id"]:
                same = tuple(f for f in M.FIELDS if a[f] is not None and a[f] == b[f])
                if same:
                    out[a["id"], b["id"]] = (sum(W[f] for f in same), same, a["site"] != b["site"])
    return out


def test_profile_equals_brute_force(people, scores):
    for r in M.identity_profile(people, "id").collect():
        mine = [s for (a, _), (s, _, _) in scores.items() if a == r["id"]]
        assert r["candidates"] == len(mine) and r["highest_score"] == max(mine, default=0)
        assert r["band_70"] == sum(70 <= s < 90 for s in mine) and r["manual_review"] == sum(50 <= s < 80 for s in mine)


def test_profile_against_another_table(people, scores):
    sites = {r["id"]: r["site"] for r in people.collect()}
    got = {r["id"]: r["candidates"] for r in M.identity_profile(people.filter("site = 's1'"), "id", people.filter("site <> 's1'")).collect()}
    want = Counter(a for (a, b) in scores if sites[a] == "s1" and sites[b] != "s1")
    assert got == {i: want[i] for i, s in sites.items() if s == "s1"}


def test_patterns_equal_brute_force(people, scores):
    want = Counter(fields for (a, b), (_, fields, _) in scores.items() if a < b)
    got = {tuple(f for f in M.FIELDS if r[f"{f}_matched"]): r["occurrences"] for r in M.identity_patterns(people).collect()}
    assert got == dict(want)


def test_cross_group_equals_brute_force(people, scores):
    want = Counter(a for (a, _), (s, _, other) in scores.items() if s >= 70 and other)
    got = {r["id"]: r["match_count"] for r in M.cross_group_matches(people, "id", "site", 70, 2).collect()}
    assert got == {a: n for a, n in want.items() if n >= 2}


def test_links_are_linear_and_span_each_group(people, scores):
    links = M.identity_links(people, "id", 50).collect()
    assert len(links) <= 11 * people.count()
    for r in links:
        assert scores[r["id"], r["linked_id"]][0] == r["score"] >= 50
    parent = list(range(240))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        parent[root(r["id"])] = root(r["linked_id"])
    assert all(root(a) == root(b) for (a, b), (s, _, _) in scores.items() if s >= 50)


S, T = M.SiteColumns("sid"), M.SiteColumns("tid")


@pytest.fixture(scope="module")
def sites(spark):
    addr = lambda n: (f" {n} Main", "Town", "ca", "123")
    src = [
        (1, "a", None, *addr(1)), (2, "b", None, *addr(2)), (3, "c", None, *addr(2)), (4, "d", "t4", *addr(9)), (5, "e", None, *addr(5)), (6, "Guarantor x", None, *addr(1)),
        (7, "g", None, None, "Town", "ca", "123"), (8, "h", "gone", *addr(1)),
    ] + [(100 + i, "hot", None, *addr(77)) for i in range(40)]
    tgt = [
        ("t1", "A", "1 MAIN", "town", "CA", "00123", None, False), ("t2", "B", "2 Main ", "Town", "CA", "00123-4", None, False), ("t4", "D", "4 Main", "Town", "CA", "00123", 44, False),
        ("t5", "E", "5 main", "Town", "CA", "00123", 5, False), ("t6", "F", "5 main", "Town", "CA", "00123", None, False), ("t7", "G", None, "Town", "CA", "00123", None, False),
        ("gone", "H", "1 Main", "Town", "CA", "00123", None, True),
    ] + [(f"h{i}", "hot", "77 Main", "Town", "CA", "00123", None, False) for i in range(30)]
    s = spark.createDataFrame(src, "sid int, name string, ref string, street string, city string, state string, zip string")
    t = spark.createDataFrame(tgt, "tid string, name string, street string, city string, state string, zip string, ov int, del boolean")
    return s, t


ARGS = ("ref", "ov", "del", "%Guarantor%")


def test_direct_match_takes_the_override_and_skips_deleted(sites, rows):
    assert rows(M.match_direct(*sites, S, T, *ARGS), "target_id", "source_id") == [("t4", 44)]


def test_address_match_counts_targets_instead_of_listing_pairs(sites, rows):
    got = M.match_address(*sites, S, T, *ARGS)
    assert rows(got.filter("source_id < 100"), "source_id", "target_id", "target_copies") == [(1, "t1", 1), (2, "t2", 1), (3, "t2", 1), (5, "t5", 1), (5, "t6", 1)]
    hot = got.filter("source_id >= 100")
    assert hot.count() == 40 and {r["target_copies"] for r in hot.collect()} == {30}


def test_labels_and_links(sites, rows):
    found = resolution.matches(*sites, S, T, *ARGS)
    labelled = M.label_duplicates(found)
    assert rows(labelled.filter("source_id < 100"), "source_id", "target_id", "dupe_status", "extra_duplicate_flag") == [
        (1, "t1", "No Dupe", 0), (2, "t2", "Both Dupe", 0), (3, "t2", "Both Dupe", 0), (44, "t4", "No Dupe", 0), (5, "t5", "Overridden Both Dupe", 0), (5, "t6", "Overridden Both Dupe", 1),
    ]
    hot = labelled.filter("source_id >= 100").first()
    assert (hot["target_copy_number"], hot["source_copy_number"], hot["dupe_status"]) == (1200, 1200, "Both Dupe")
    links = M.resolve_links(labelled.withColumn("final_status", F.col("dupe_status")))
    assert rows(links, "source_id", "target_id") == [(1, "t1"), (44, "t4"), (5, "t5")]


def test_duplicate_members_list_every_record_once(sites, rows):
    got = M.duplicate_members(resolution.matches(*sites, S, T, *ARGS), sites[1], T, "ov", "del")
    small = got.filter("other_copies < 10")
    assert rows(small, "side", "id", "copies", "other_copies") == [("source", "2", 2, 1), ("source", "3", 2, 1), ("source", "5", 1, 2), ("target", "t2", 1, 2), ("target", "t5", 2, 1), ("target", "t6", 2, 1)]
    hot = got.filter("other_copies >= 10").collect()
    assert {r["id"] for r in hot} == {f"h{i}" for i in range(30)} | {str(100 + i) for i in range(40)} and len(hot) == 70
    assert {(r["side"], r["copies"], r["other_copies"]) for r in hot} == {("target", 30, 40), ("source", 40, 30)} and len({r["addr"] for r in hot}) == 1


def test_partner_exception_clears_a_pair_of_source_rows(spark, rows):
    data = [("t1", 1, "A", "B", None, "DIRECT", 1), ("t2", 2, "A", "C", None, "DIRECT", 1), ("t3", 3, "D", "E", None, "DIRECT", 1), ("t4", 4, "D", "F", None, "DIRECT", 1)]
    found = spark.createDataFrame(data, "target_id string, source_id int, src_addr string, tgt_addr string, override_id int, match_method string, target_copies bigint")
    got = M.duplicate_exceptions(M.label_duplicates(found), spark.createDataFrame([("A",), ("A",)], "addr string"))
    assert rows(got, "source_id", "dupe_status", "final_status") == [(1, "Source Dupe", "No Dupe"), (2, "Source Dupe", "No Dupe"), (3, "Source Dupe", "Source Dupe"), (4, "Source Dupe", "Source Dupe")]


def test_account_lookup_has_one_row_per_name(spark, rows):
    acc = spark.createDataFrame([(1, " Acme", 5, "u1"), (2, "ACME ", 5, "u2"), (3, "Bolt", None, None), (4, " ", 1, "u1")], "aid int, name string, m int, own string")
    users = spark.createDataFrame([("u1", "Ann"), ("u2", "Bo")], "uid string, uname string")
    got = M.account_lookup(acc, users, "aid", "name", "m", {"owner": "own"}, "uid", "uname")
    assert rows(got, "name_key", "aid", "owner") == [("acme", 1, "Ann"), ("bolt", 3, None)]


@pytest.fixture(scope="module")
def applicants(spark):
    """One name that a third of all records share, on few days; equal times, no times, no places."""
    rng = random.Random(11)
    data = []
    for i in range(240):
        first, last = ("ann", "lee") if i % 3 == 0 else (rng.choice("abcd"), rng.choice(["x", "y", None]))
        hours = rng.randrange(60) if i % 3 == 0 else rng.randrange(2400)
        data.append((i, first, last, f"{rng.randrange(40)}@x", rng.choice(["1", "2", None, str(i)]), None if i % 50 == 7 else hours, rng.choice(["p", "q", "r", "s", "t", "u", None])))
    df = spark.createDataFrame(data, "id int, first_name string, last_name string, email string, phone string, hours int, place string")
    return df.withColumn("t", F.timestamp_seconds(F.lit(1704067200) + F.col("hours") * 3600).cast("timestamp_ntz")).cache()


def within(recs, r, days):
    return [o for o in recs if o["t"] is not None and r["t"] is not None and 0 <= (r["t"] - o["t"]).total_seconds() < days * 86400]


@pytest.mark.parametrize("size", [25, 10_000])
def test_recent_matches_equal_the_self_join(applicants, size):
    recs = applicants.collect()
    want = {}
    for r in recs:
        scores = [sum(M.WEIGHTS[f] for f in M.FIELDS if r[f] is not None and r[f] == o[f]) for o in within(recs, r, 30) if o["id"] != r["id"]]
        n = sum(s >= 50 for s in scores)
        if n > 3:
            want[r["id"]] = (n, max(scores))
    got = {r["id"]: (r["match_count"], r["highest_score"]) for r in R.recent_matches(applicants, "id", "t", 30, 50, 3, size).collect()}
    assert got == want and len(want) > 50


@pytest.mark.parametrize("size", [25, 10_000])
def test_recent_places_equal_the_self_join(applicants, size):
    recs = applicants.collect()
    by = [("email",), ("first_name", "last_name")]
    want = {}
    for r in recs:
        for fields in by:
            near = [o for o in within(recs, r, 3) if all(r[f] is not None and r[f] == o[f] for f in fields)]
            places = {o["place"] for o in near} - {None}
            if len(places) >= 2:
                want[r["id"], ", ".join(fields)] = len(places)
    got = {(r["id"], r["shared"]): r["places"] for r in R.recent_places(applicants, "id", "t", "place", by, 3, 2, size).collect()}
    assert got == want and len(want) > 50


def test_larger_subsets_are_built_only_where_smaller_ones_are_shared(spark):
    """Records that share only their first names go into no shuffle beyond their four single fields."""
    df = spark.range(300).select("id", F.concat(F.lit("n"), F.col("id") % 50).alias("first_name"), *[F.concat(F.lit(f), "id").alias(f) for f in ("last_name", "email", "phone")])
    found = M.shared_keys(df)
    assert found.count() == 300 and found.select("mask").distinct().count() == 1
    twins = df.unionByName(df.filter("id < 10").withColumn("id", F.col("id") + 1000))
    assert M.shared_keys(twins).groupBy("mask").count().count() == 15


def test_profile_builds_fewer_than_fifteen_keys_per_identity(applicants):
    """Keys built on a level are the ones that could be shared; on these records far fewer than all fifteen."""
    identities = applicants.select(*M.FIELDS).distinct().count()
    assert M.shared_keys(applicants).count() < 9 * identities
