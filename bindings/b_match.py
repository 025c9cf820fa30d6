"""J11, J12, J14-J17, J21-J24, J33."""

from pyspark.sql import functions as F

from bindings.base import query
from crosswalk.operators import match as M
from crosswalk.operators import recent as R
from crosswalk.plans import resolution

S, T = M.SiteColumns("source_id"), M.SiteColumns("target_id")
ARGS = ("target_ref", "override_id", "is_deleted", "%green nut%")

KEYS = """
s AS (SELECT *, CASE WHEN trim(street) <> '' AND trim(city) <> '' AND trim(state) <> '' AND trim(zip) <> '' THEN
    upper(trim(street)) || '|' || upper(trim(city)) || '|' || upper(trim(state)) || '|' || lpad(substr(trim(zip), 1, 5), 5, '0') END AS addr FROM src_site WHERE name NOT LIKE '%green nut%'),
t AS (SELECT *, CASE WHEN trim(street) <> '' AND trim(city) <> '' AND trim(state) <> '' AND trim(zip) <> '' THEN
    upper(trim(street)) || '|' || upper(trim(city)) || '|' || upper(trim(state)) || '|' || lpad(substr(trim(zip), 1, 5), 5, '0') END AS addr FROM tgt_site WHERE NOT is_deleted),
direct AS (SELECT t.target_id, COALESCE(t.override_id, s.source_id) AS source_id, s.addr AS src_addr, t.addr AS tgt_addr, t.override_id, 'DIRECT' AS match_method
  FROM s JOIN t ON s.target_ref = t.target_id),
address AS (SELECT t.target_id, s.source_id, s.addr AS src_addr, t.addr AS tgt_addr, t.override_id, 'ADDRESS' AS match_method FROM s JOIN t ON s.addr = t.addr
  WHERE s.target_ref IS NULL AND (t.override_id IS NULL OR t.override_id = s.source_id)),
pairs AS (SELECT * FROM direct UNION ALL SELECT * FROM address)
"""
LABELS = KEYS + """,
counted AS (SELECT *, CASE WHEN tgt_addr IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY tgt_addr) END AS tc, CASE WHEN src_addr IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY src_addr) END AS sc,
  CASE WHEN tgt_addr IS NULL THEN 0 ELSE count(override_id) OVER (PARTITION BY tgt_addr) END AS orr FROM pairs),
sides AS (SELECT *, tc > 1 AS on_target, sc > 1 AS on_source, orr > 0 AS overridden FROM counted),
dupes AS (SELECT *, CASE WHEN overridden AND override_id IS NULL THEN 1 ELSE 0 END AS extra,
  CASE WHEN on_target OR on_source THEN CASE WHEN overridden THEN 'Overridden ' ELSE '' END || CASE WHEN on_target AND on_source THEN 'Both' WHEN on_target THEN 'Target' ELSE 'Source' END || ' Dupe' ELSE 'No Dupe' END AS dupe_status FROM sides),
partner AS (SELECT DISTINCT p.src_addr FROM pairs p JOIN src_site x ON x.source_id = p.source_id JOIN owner o ON o.owner_id = x.owner_id AND o.is_partner
  WHERE p.src_addr IS NOT NULL AND x.name <> 'red bolt'),
final AS (SELECT d.*, CASE WHEN p.src_addr IS NOT NULL AND tc = 1 AND sc = 2 THEN 'No Dupe' ELSE dupe_status END AS final_status FROM dupes d LEFT JOIN partner p ON p.src_addr = d.src_addr)
"""
LINKS = LABELS + """,
send AS (SELECT DISTINCT target_id, source_id, override_id, match_method FROM final WHERE final_status = 'No Dupe' OR (override_id IS NOT NULL AND extra = 0)),
links AS (SELECT * FROM send WHERE override_id IS NOT NULL UNION ALL SELECT * FROM send WHERE override_id IS NULL AND source_id NOT IN (SELECT source_id FROM send WHERE override_id IS NOT NULL))
"""


def found(i):
    return resolution.matches(i.src_site, i.tgt_site, S, T, *ARGS)


def marked(i, rows=None):
    partners = i.src_site.join(i.owner.filter("is_partner"), "owner_id", "left_semi").select("source_id")
    return resolution.labelled(rows or found(i), i.src_site, S, partners, ["red bolt"])


def links(i):
    return M.resolve_links(marked(i))


@query("j11_match_direct", f"WITH {KEYS} SELECT target_id, source_id, override_id, match_method FROM direct")
def j11(i):
    return M.match_direct(i.src_site, i.tgt_site, S, T, *ARGS).select("target_id", "source_id", "override_id", "match_method")


@query("j12_match_address", f"""
WITH {KEYS} SELECT min(target_id) AS target_id, source_id, count(*) AS target_copies, override_id FROM address WHERE override_id IS NULL GROUP BY source_id, override_id
UNION ALL SELECT target_id, source_id, 1, override_id FROM address WHERE override_id IS NOT NULL
""")
def j12(i):
    return M.match_address(i.src_site, i.tgt_site, S, T, *ARGS).select("target_id", "source_id", "target_copies", "override_id")


@query("j14_label_duplicates", f"""
WITH {LABELS} SELECT min(target_id) AS target_id, source_id, count(*) AS target_copies, override_id, match_method, tc AS target_copy_number, sc AS source_copy_number, orr AS override_records,
  extra AS extra_duplicate_flag, dupe_status FROM dupes WHERE match_method = 'ADDRESS' AND override_id IS NULL GROUP BY ALL
UNION ALL SELECT target_id, source_id, 1, override_id, match_method, tc, sc, orr, extra, dupe_status FROM dupes WHERE NOT (match_method = 'ADDRESS' AND override_id IS NULL)
""")
def j14(i):
    return M.label_duplicates(found(i)).drop("src_addr", "tgt_addr")


@query("j15_duplicate_exceptions", f"WITH {LABELS} SELECT final_status, match_method, count(*) AS pairs FROM final GROUP BY 1, 2")
def j15(i):
    return resolution.status_summary(marked(i))


@query("j16_resolve_links", f"""
WITH {LINKS} SELECT l.target_id, l.source_id, l.override_id, l.match_method, CASE WHEN o.is_partner AND o.owner_id < 10 THEN 'Integration' WHEN o.is_partner THEN o.owner_name END AS created_by
FROM links l JOIN src_site s ON s.source_id = l.source_id LEFT JOIN owner o ON o.owner_id = s.owner_id
""")
def j16(i):
    rows = i.src_site.join(i.owner, "owner_id", "left")
    rules = [(F.col("is_partner") & (F.col("owner_id") < 10), "Integration"), (F.col("is_partner"), F.col("owner_name"))]
    return M.created_by(links(i), rows, "source_id", rules)


@query("j14_duplicate_members", f"""
WITH {KEYS}, m AS (SELECT tgt_addr AS addr, 'target' AS side, CAST(target_id AS VARCHAR) AS id FROM pairs UNION SELECT src_addr, 'source', CAST(source_id AS VARCHAR) FROM pairs),
n AS (SELECT addr, count(*) FILTER (WHERE side = 'target') AS t, count(*) FILTER (WHERE side = 'source') AS s FROM m WHERE addr IS NOT NULL GROUP BY addr)
SELECT side, id, if(side = 'target', t, s) AS copies, if(side = 'target', s, t) AS other_copies FROM m JOIN n USING (addr) WHERE t > 1 OR s > 1
""")
def j14_members(i):
    return M.duplicate_members(found(i), i.tgt_site, T, "override_id", "is_deleted").drop("addr")


@query("c3_open_duplicates", f"""
WITH {LABELS} SELECT source_id, final_status, count(*) AS pairs FROM final WHERE final_status <> 'No Dupe' AND final_status NOT LIKE 'Overridden%' GROUP BY 1, 2
""")
def c3_open(i):
    return resolution.open_duplicates(marked(i)).groupBy("source_id", "final_status").agg(F.sum("target_copies").alias("pairs"))


VERSIONS = LINKS + """,
v1 AS (SELECT target_id, source_id, 'ADDRESS' AS method FROM address WHERE override_id IS NULL AND target_id IN (SELECT target_id FROM address GROUP BY target_id HAVING count(*) = 1)),
v2 AS (SELECT target_id, source_id, match_method AS method FROM links),
p AS (SELECT COALESCE(v1.target_id, v2.target_id) AS target_id, COALESCE(v1.source_id, v2.source_id) AS source_id, CASE WHEN v1.target_id IS NULL THEN 'NEW' WHEN v2.target_id IS NULL THEN 'LOST' ELSE 'KEPT' END AS change
  FROM (SELECT DISTINCT target_id, source_id FROM v1) v1 FULL OUTER JOIN (SELECT DISTINCT target_id, source_id FROM v2) v2 ON v1.target_id = v2.target_id AND v1.source_id = v2.source_id)
"""


def versions(i):
    """An earlier method (address only, targets with a single source row) against the present links."""
    rows = M.with_address(i.src_site.filter("target_ref IS NULL AND NOT name LIKE '%green nut%'"), S).filter("addr IS NOT NULL")
    one = rows.groupBy("addr").agg(F.count(F.lit(1)).alias("n"), F.min("source_id").alias("source_id")).filter("n = 1")
    targets = M.with_address(i.tgt_site.filter("NOT is_deleted AND override_id IS NULL"), T).filter("addr IS NOT NULL")
    v1 = targets.join(one, "addr").select("target_id", "source_id", F.lit("ADDRESS").alias("method"))
    return v1, links(i).select("target_id", "source_id", F.col("match_method").alias("method"))


@query("j17_match_version_counts", f"""
WITH {VERSIONS}, a AS (SELECT count(DISTINCT target_id) t, count(DISTINCT source_id) s, count(*) n FROM v1), b AS (SELECT count(DISTINCT target_id) t, count(DISTINCT source_id) s, count(*) n FROM v2)
SELECT 'V1' AS version, t AS targets, s AS sources, n AS records FROM a UNION ALL SELECT 'V2', t, s, n FROM b UNION ALL SELECT 'Difference', b.t - a.t, b.s - a.s, b.n - a.n FROM a, b
""")
def j17(i):
    return M.match_version_counts(*versions(i))


@query("j17_match_version_pairs", f"WITH {VERSIONS} SELECT * FROM p")
def j17_pairs(i):
    return M.match_version_pairs(*versions(i))


@query("j17_match_overlap", f"""
WITH {VERSIONS} SELECT count(*) FILTER (WHERE change = 'KEPT') AS in_both, count(*) FILTER (WHERE change = 'NEW') AS only_v2, count(*) FILTER (WHERE change = 'LOST') AS only_v1,
  round(100.0::DOUBLE * count(*) FILTER (WHERE change = 'KEPT') / count(*) FILTER (WHERE change <> 'NEW'), 2) AS pct_of_v1,
  round(100.0::DOUBLE * count(*) FILTER (WHERE change = 'KEPT') / count(*) FILTER (WHERE change <> 'LOST'), 2) AS pct_of_v2 FROM p
""")
def j17_overlap(i):
    return M.match_overlap(M.match_version_pairs(*versions(i)))


@query("j17_lost_pair_causes", f"""
WITH {VERSIONS} SELECT CASE WHEN s.source_id IS NULL THEN 'source row gone' WHEN s.target_ref IS NULL THEN 'no stored id' WHEN s.target_ref = p.target_id THEN 'stored id is this target'
  ELSE 'stored id is another target' END AS cause, count(*) AS pairs FROM p LEFT JOIN src_site s ON s.source_id = p.source_id WHERE change = 'LOST' GROUP BY 1
""")
def j17_lost(i):
    return M.lost_pair_causes(M.match_version_pairs(*versions(i)), i.src_site, "source_id", "target_ref")


@query("j17_match_distribution", f"""
WITH {VERSIONS} SELECT 'V1' AS version, method AS label, count(*) AS records, count(DISTINCT target_id) AS targets, count(DISTINCT source_id) AS sources FROM v1 GROUP BY method
UNION ALL SELECT 'V2', method, count(*), count(DISTINCT target_id), count(DISTINCT source_id) FROM v2 GROUP BY method
""")
def j17_distribution(i):
    v1, v2 = versions(i)
    return M.match_distribution({"V1": v1, "V2": v2}, "method")


PEOPLE = r"""
people AS (SELECT id, site, CASE WHEN split_part(full_name, ' ', 1) = 'BLUE' THEN NULL ELSE regexp_replace(lower(trim(split_part(full_name, ' ', 1))), '[^a-z0-9 ]', '', 'g') END AS first_name,
  regexp_replace(lower(trim(split_part(full_name, ' ', 2))), '[^a-z0-9 ]', '', 'g') AS last_name,
  replace(regexp_replace(split_part(lower(email), '@', 1), '\+.*$', ''), '.', '') || '@' || split_part(lower(email), '@', 2) AS email, regexp_replace(phone, '[^0-9]', '', 'g') AS phone FROM person)
"""
SCORED = PEOPLE + """,
pair AS (SELECT a.id AS a_id, b.id AS b_id, a.site AS a_site, b.site AS b_site, COALESCE(a.first_name = b.first_name, FALSE) AS f, COALESCE(a.last_name = b.last_name, FALSE) AS l, COALESCE(a.email = b.email, FALSE) AS e,
  COALESCE(a.phone = b.phone, FALSE) AS p FROM people a JOIN people b ON a.id <> b.id),
scored AS (SELECT *, CAST(f AS INT) * 25 + CAST(l AS INT) * 25 + CAST(e AS INT) * 30 + CAST(p AS INT) * 20 AS score FROM pair WHERE f OR l OR e OR p),
prof AS (SELECT x.id, x.first_name, x.last_name, x.email, x.phone, count(s.a_id) AS candidates, COALESCE(max(score), 0) AS highest_score, count(*) FILTER (WHERE score >= 90) AS band_90,
  count(*) FILTER (WHERE score >= 70 AND score < 90) AS band_70, count(*) FILTER (WHERE score >= 50 AND score < 70) AS band_50, count(*) FILTER (WHERE score >= 30 AND score < 50) AS band_30,
  count(*) FILTER (WHERE score < 30) AS band_0, count(*) FILTER (WHERE score >= 80) AS auto_flag, count(*) FILTER (WHERE score >= 50 AND score < 80) AS manual_review
  FROM people x LEFT JOIN scored s ON s.a_id = x.id GROUP BY ALL)
"""


def people(i):
    first = F.split_part("full_name", F.lit(" "), F.lit(1))
    first = F.when(first != "BLUE", first)
    return M.identity_normalise(i.person, ["id", "site"], first, F.split_part("full_name", F.lit(" "), F.lit(2)), F.col("email"), F.col("phone"))


def profile(i):
    return M.identity_profile(people(i), "id")


@query("j21_identity_normalise", f"WITH {PEOPLE} SELECT * FROM people")
def j21(i):
    return people(i)


@query("j22_identity_profile", f"WITH {SCORED} SELECT * FROM prof")
def j22(i):
    return profile(i)


@query("j22_identity_against", f"""
WITH {PEOPLE}, stored AS (SELECT first_name, last_name, CASE WHEN last_name = 'ring' THEN NULL ELSE email END AS email, phone || '0' AS phone FROM people UNION ALL SELECT first_name, NULL, email, phone FROM people),
hit AS (SELECT a.id, CAST(COALESCE(a.first_name = b.first_name, FALSE) AS INT) * 25 + CAST(COALESCE(a.last_name = b.last_name, FALSE) AS INT) * 25
  + CAST(COALESCE(a.email = b.email, FALSE) AS INT) * 30 + CAST(COALESCE(a.phone = b.phone, FALSE) AS INT) * 20 AS score FROM people a, stored b)
SELECT id, count(*) FILTER (WHERE score > 0) AS candidates, max(score) AS highest_score FROM hit GROUP BY id
""")
def j22_against(i):
    """Every person against stored variations: one with another phone, one without a last name."""
    known = people(i)
    email = F.when(F.coalesce(F.col("last_name") != "ring", F.lit(True)), F.col("email"))
    other = known.withColumn("email", email).withColumn("phone", F.concat("phone", F.lit("0")))
    stored = other.unionByName(known.withColumn("last_name", F.lit(None).cast("string")))
    return M.identity_profile(known, "id", stored).select("id", "candidates", "highest_score")


LINK_SETS = [("f", 25, "first_name"), ("l", 25, "last_name"), ("e", 30, "email"), ("p", 20, "phone")]


def link_sql(min_score: int) -> str:
    parts = []
    for subset in M.SUBSETS:
        if M.subset_score(subset) >= min_score:
            by = ", ".join(subset)
            known = " AND ".join(f"{f} IS NOT NULL" for f in subset)
            parts.append(f"SELECT id, min(id) OVER (PARTITION BY {by}) AS linked_id FROM people WHERE {known}")
    return " UNION ".join(parts)


@query("j22_identity_links", f"""
WITH {SCORED}, lk AS ({link_sql(50)}) SELECT lk.id, lk.linked_id, s.f AS first_name_matched, s.l AS last_name_matched, s.e AS email_matched, s.p AS phone_matched, s.score,
  CASE WHEN s.score >= 90 THEN '90-100 (Very High)' WHEN s.score >= 70 THEN '70-89 (High)' ELSE '50-69 (Medium)' END AS band FROM lk JOIN scored s ON s.a_id = lk.id AND s.b_id = lk.linked_id
""")
def j22_links(i):
    return M.identity_links(people(i), "id", 50)


@query("j23_identity_patterns", f"""
WITH {SCORED} SELECT f AS first_name_matched, l AS last_name_matched, e AS email_matched, p AS phone_matched, count(*) AS occurrences, score FROM scored WHERE a_id < b_id GROUP BY ALL
""")
def j23(i):
    return M.identity_patterns(people(i))


@query("j23_score_distribution", f"""
WITH {SCORED} SELECT CASE WHEN score >= 90 THEN '90-100 (Very High)' WHEN score >= 70 THEN '70-89 (High)' WHEN score >= 50 THEN '50-69 (Medium)' WHEN score >= 30 THEN '30-49 (Low)'
  ELSE '0-29 (Very Low)' END AS band, count(*) AS match_count FROM scored WHERE a_id < b_id GROUP BY 1
""")
def j23_distribution(i):
    return M.identity_score_distribution(M.identity_patterns(people(i)))


@query("j23_match_rate", f"""
WITH {SCORED} SELECT count(*) AS total, count(*) FILTER (WHERE highest_score >= 70) AS with_matches, round(100.0::DOUBLE * count(*) FILTER (WHERE highest_score >= 70) / count(*), 2) AS match_rate FROM prof
""")
def j23_rate(i):
    return M.identity_match_rate(profile(i))


@query("j23_serial_entities", f"WITH {SCORED} SELECT id, band_50 + band_70 + band_90 AS match_count, highest_score FROM prof WHERE band_50 + band_70 + band_90 >= 5")
def j23_serial(i):
    return M.serial_entities(profile(i), 5, 50).select("id", "match_count", "highest_score")


APPLIED = PEOPLE + """,
applied AS (SELECT people.*, to_timestamp(1704067200 + (id % 200) * 86400 + id % 7 * 3600)::TIMESTAMP AS applied_at FROM people)
"""


def applied(i):
    """People with the time at which they applied, over 200 days."""
    seconds = F.lit(1704067200) + F.col("id") % 200 * 86400 + F.col("id") % 7 * 3600
    return people(i).withColumn("applied_at", F.timestamp_seconds(seconds).cast("timestamp_ntz"))


@query("j23_recent_serial", f"""
WITH {APPLIED}, scored AS (SELECT a.id, a.applied_at, CAST(COALESCE(a.first_name = b.first_name, FALSE) AS INT) * 25 + CAST(COALESCE(a.last_name = b.last_name, FALSE) AS INT) * 25
  + CAST(COALESCE(a.email = b.email, FALSE) AS INT) * 30 + CAST(COALESCE(a.phone = b.phone, FALSE) AS INT) * 20 AS score
  FROM applied a JOIN applied b ON a.id <> b.id AND b.applied_at <= a.applied_at AND b.applied_at > a.applied_at - INTERVAL 30 DAYS)
SELECT id, applied_at, count(*) FILTER (WHERE score >= 50) AS match_count, max(score) AS highest_score FROM scored GROUP BY id, applied_at HAVING count(*) FILTER (WHERE score >= 50) > 3
""")
def j23_recent(i):
    """Cut into pieces of 2,000 rows, so that common names are many of them."""
    return R.recent_matches(applied(i), "id", "applied_at", 30, 50, 3, rows=2000)


@query("j23_recent_places", f"""
WITH {APPLIED}, near AS (
  SELECT a.id, a.applied_at, 'email' AS shared, b.site FROM applied a JOIN applied b ON a.email = b.email AND b.applied_at <= a.applied_at AND b.applied_at > a.applied_at - INTERVAL 90 DAYS
  UNION ALL SELECT a.id, a.applied_at, 'phone', b.site FROM applied a JOIN applied b ON a.phone = b.phone AND b.applied_at <= a.applied_at AND b.applied_at > a.applied_at - INTERVAL 90 DAYS
  UNION ALL SELECT a.id, a.applied_at, 'first_name, last_name', b.site FROM applied a JOIN applied b ON a.first_name = b.first_name AND a.last_name = b.last_name AND b.applied_at <= a.applied_at AND b.applied_at > a.applied_at - INTERVAL 90 DAYS)
SELECT id, applied_at, shared, count(DISTINCT site) AS places FROM near GROUP BY id, applied_at, shared HAVING count(DISTINCT site) >= 5
""")
def j23_places(i):
    return R.recent_places(applied(i), "id", "applied_at", "site", [("email",), ("phone",), ("first_name", "last_name")], 90, 5, rows=2000)


@query("j33_cross_group_matches", f"""
WITH {SCORED} SELECT a_id AS id, a_site AS site, count(*) AS match_count, round(sum(score)::DOUBLE / count(*), 4) AS avg_score FROM scored WHERE score >= 70 AND a_site <> b_site
GROUP BY a_id, a_site HAVING count(*) >= 3
""")
def j33(i):
    return M.cross_group_matches(people(i), "id", "site")


@query("j24_account_lookup", """
WITH acc AS (SELECT c_custkey AS account_id, CASE WHEN c_acctbal > 0 THEN ' ' || c_mktsegment || ' ' || CAST(c_nationkey AS STRING) ELSE lower(c_mktsegment) || ' ' || CAST(c_nationkey AS STRING) END AS name,
  c_acctbal AS modified, c_nationkey AS csm_id, c_nationkey + 25 AS ae_id, c_nationkey + 90 AS sam_id FROM customer),
newest AS (SELECT * FROM (SELECT *, trim(lower(name)) AS name_key, row_number() OVER (PARTITION BY trim(lower(name)) ORDER BY modified DESC, account_id) AS rn FROM acc) WHERE rn = 1)
SELECT n.name_key, n.account_id, n.name, a.s_name AS csm, b.s_name AS ae, c.s_name AS sam FROM newest n LEFT JOIN supplier a ON a.s_suppkey = n.csm_id LEFT JOIN supplier b ON b.s_suppkey = n.ae_id
LEFT JOIN supplier c ON c.s_suppkey = n.sam_id
""")
def j24(i):
    place = F.concat("c_mktsegment", F.lit(" "), F.col("c_nationkey").cast("string"))
    accounts = i.customer.select(
        F.col("c_custkey").alias("account_id"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit(" "), place)).otherwise(F.concat(F.lower("c_mktsegment"), F.lit(" "), F.col("c_nationkey").cast("string"))).alias("name"),
        F.col("c_acctbal").alias("modified"), F.col("c_nationkey").alias("csm_id"), (F.col("c_nationkey") + 25).alias("ae_id"), (F.col("c_nationkey") + 90).alias("sam_id"),
    )
    return M.account_lookup(
        accounts, i.supplier, "account_id", "name", "modified", {"csm": "csm_id", "ae": "ae_id", "sam": "sam_id"}, "s_suppkey", "s_name"
    )
