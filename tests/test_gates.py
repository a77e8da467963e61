"""Gates of entity attachment and the support behind attachments, against literal rows."""

from lodestar.operators import chain, publication, support, waterfall

LISTED = "symbol string, raw_isin string, isin_status string, isin_error_reason string, country string, provider_country string, exchange_code string, name string, provider_name string"
M = "isin_prefix_mismatch"
ROWS = [
    ("A", "DE1", "suspect", M, "us", None, None, "Acme Inc", None),
    ("B", "DE1", "suspect", M, "DE", None, None, "Acme Inc", None),
    ("C", " ", "suspect", M, None, "US", None, "Acme Inc", None),
    ("D", "DE9", "suspect", M, None, None, "us", "Acme Inc", None),
    ("E", "DE2", "suspect", M, "US", None, None, "Acme Inc", None),
    ("F", "DE3", "suspect", M, "US", None, None, "Acme Inc", "Beta Public"),
    ("G", "DE1", "suspect", "invalid_isin", "US", None, None, "Acme Inc", None),
    ("H", "DE1", "success", None, "DE", None, None, "Acme Inc", None),
    ("I", "DE2", "success", None, "US", None, None, "None such", None),
]
RECORDS = [("DE1", "success", "L1", "ACME"), ("DE2", "error", "L2", "ACME"), ("DE3", "success", "L3", "Beta")]
RECORD = "isin string, record_status string, lei string, legal_name string"


def frames(spark, *given):
    return [spark.createDataFrame(rows, schema) for rows, schema in given]


def test_suspect_prefixes_attach_us_listings_of_the_name_only(spark):
    listings, records = frames(spark, (ROWS, LISTED), (RECORDS, RECORD))
    got = {r.symbol: (r["_lei"], r["_why"]) for r in waterfall.prefix_mismatches(listings, records).collect()}
    assert got == {
        "A": ("L1", None), "B": (None, "direct_prefix_mismatch_non_us_listing"), "C": (None, "missing_raw_isin"), "D": (None, "direct_prefix_mismatch_no_gleif_lei"),
        "E": (None, "direct_prefix_mismatch_no_gleif_lei"), "F": ("L3", None), "G": (None, None), "H": (None, None), "I": (None, None),
    }
    other = frames(spark, ([("A", "DE3", "suspect", M, "US", None, None, "Acme", "Acme Ltd")], LISTED))[0]
    assert waterfall.prefix_mismatches(other, records).first()["_why"] == "direct_prefix_mismatch_name_unconfirmed"


CANDIDATE = "symbol string, place int, lei string, legal_name string, legal_country string, headquarters_country string, jurisdiction string"
EXPANSION = "lei string, expansion_status string, isins array<string>"


def test_foreign_issuers_need_exactly_one_confirmed_candidate(spark):
    own = lambda s, isin=None, country="US": (s, isin, None, None, country, None, None, "Acme Public", None)
    listings = [own("one"), own("two"), own("named"), own("missing"), own("failed"), own("elsewhere"), own("byown", "jp7"), own("usown", "US7"), own("none"), own("abroad", None, "DE")]
    candidates = [
        ("one", 2, "L1", "ACME INC", "de", None, None), ("one", 1, "L2", "Other", "DE", None, None), ("two", 1, "L1", "Acme", "DE", None, None), ("two", 2, "L3", "Acme", None, "FR", None), ("named", 1, "L1", "Other", "DE", None, None),
        ("missing", 1, "L9", "Acme", "DE", None, None), ("failed", 1, "L4", "Acme", "DE", None, None), ("elsewhere", 1, "L1", "Acme", "Germany", None, None), ("byown", 1, "L5", "Acme", None, None, None), ("usown", 1, "L5", "Acme", None, None, None), ("abroad", 1, "L1", "Acme", "DE", None, None),
    ]
    expansions = [("L1", "success", ["DE1", " de1 ", "US1"]), ("L3", "success", ["FR1"]), ("L4", "error", ["DE1"]), ("L5", "success", ["JP7", "US7"])]
    found = waterfall.foreign_issuers(*frames(spark, (listings, LISTED), (candidates, CANDIDATE), (expansions, EXPANSION)))
    got = {r.symbol: (r["_lei"], r["_why"], r.issuer_lei) for r in found.collect()}
    assert got == {
        "one": ("L1", None, "L1"), "two": (None, "multiple_foreign_issuer_candidates", "L1,L3"), "named": (None, "name_unconfirmed", "L1"), "missing": (None, "lei_expansion_missing", "L9"), "failed": (None, "lei_expansion_not_success", "L4"),
        "elsewhere": (None, "no_confirming_foreign_issuer_isin", "L1"), "byown": ("L5", None, "L5"), "usown": (None, "no_confirming_foreign_issuer_isin", "L5"), "none": (None, "no_legal_name_candidate", None), "abroad": (None, "not_us_listing", None),
    }


def test_only_unresolved_rows_go_on_and_keep_why(spark):
    listings, records = frames(spark, (ROWS, LISTED), (RECORDS, RECORD))
    gates = [("direct", lambda rows: waterfall.direct_isins(rows, records)), ("prefix", lambda rows: waterfall.prefix_mismatches(rows, records))]
    got = {r.symbol: (r.entity_lei, r.method, [tuple(x) for x in r.refused]) for r in waterfall.waterfall(listings, gates).collect()}
    assert len(got) == len(ROWS)
    assert got["H"] == ("L1", "direct", []) and got["A"] == ("L1", "prefix", [("direct", "isin_suspect")])
    assert got["E"] == (None, "unattached", [("direct", "isin_suspect"), ("prefix", "direct_prefix_mismatch_no_gleif_lei")])
    assert got["I"] == (None, "unattached", [("direct", "valid_isin_no_gleif_lei")])


ATTACHED = {
    "symbol": "string", "entity_lei": "string", "lei": "string", "entity_attach_method": "string", "curated_identity_source": "string", "direct_lei": "string", "direct_prefix_mismatch_lei": "string", "isin": "string", "raw_isin": "string", "foreign_issuer_raw_isin": "string",
    "foreign_issuer_raw_isin_in_expansion": "boolean", "candidate_lei": "string", "foreign_issuer_candidate_lei": "string", "candidate_legal_name": "string", "legal_name": "string", "internal_candidate_name": "string", "openfigi_name": "string",
    "listing_name_used_for_legal_name_search": "string", "legal_name_anchor_status": "string", "foreign_issuer_name_match_status": "string", "compatible_isin_gate_status": "string", "matched_compatible_isins": "array<string>",
}


def test_safe_needs_support_and_holds_publication_otherwise(spark):
    base = {"candidate_legal_name": "Acme Holdings", "internal_candidate_name": "Acme Holdings"}
    name = {"entity_attach_method": "name_anchor_confirmed", "matched_compatible_isins": ["de1"]}
    cases = {
        "strong": base | name | {"entity_lei": "L1"}, "weak": base | name | {"entity_lei": "L2"}, "reviewed": base | name | {"entity_lei": "L3"}, "unmatched": base | name | {"entity_lei": "L1", "internal_candidate_name": "Zeta"},
        "expanded": base | {"entity_attach_method": "lei_expansion", "entity_lei": "L4", "matched_compatible_isins": ["FR1"]}, "unsupported": base | {"entity_attach_method": "lei_expansion", "entity_lei": "L5"},
        "curated": base | {"entity_attach_method": "curated_identity", "entity_lei": "L6", "curated_identity_source": "desk"}, "rival": base | {"entity_attach_method": "curated_identity", "entity_lei": "L7", "curated_identity_source": "desk", "candidate_lei": "L8"},
        "short": {"entity_attach_method": "lei_expansion", "entity_lei": "L9", "matched_compatible_isins": ["FR1"], "candidate_legal_name": "AB Inc"}, "direct": base | {"entity_attach_method": "direct_isin", "entity_lei": "L1"},
    }
    rows = [tuple(({"symbol": s} | c).get(k) for k in ATTACHED) for s, c in cases.items()]
    attached, records, reviewed = frames(
        spark, (rows, ", ".join(f"{k} {v}" for k, v in ATTACHED.items())), ([("DE1", "success", "l1"), ("DE1", "error", "L2")], "isin string, record_status string, lei string"),
        ([("REVIEWED", "L3", "name_anchor_confirmed", "approved"), ("rival", "L7", "curated_identity", "approved")], "symbol string, entity_lei string, attach_method string, review_status string"),
    )
    audit = support.attach_support(attached, records, reviewed)
    got = {r.symbol: (r.review_status, r.review_reason) for r in audit.collect()}
    assert got == {
        "strong": ("machine_verifiably_safe", None), "weak": ("needs_review", "weak_heuristic_requires_review"), "reviewed": ("reviewed_safe", None), "unmatched": ("needs_review", "legal_name_not_conservatively_matched"), "expanded": ("machine_verifiably_safe", None),
        "unsupported": ("needs_review", "missing_deterministic_support"), "curated": ("machine_verifiably_safe", None), "rival": ("needs_review", "conflicting_group_identity"), "short": ("machine_verifiably_safe", None),
    }
    from pyspark.sql import functions as F

    held = lambda df: [r.blocker for r in publication.blockers(support.gate_figures(df).withColumns({"unresolved_groups": F.lit(0), "guardrails_unmerged": F.lit(True)})).collect()]
    assert held(audit) == ["publication_gate_not_ready", "heuristic_review_required", "group_conflicts_present"] and held(audit.where("review_status <> 'needs_review'")) == []


def _join_rows(df):
    """Rows that each join of the frame's executed plan gave."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.plan()] if node.nodeName().endswith("QueryStage") else [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_name_anchors_meet_counts_and_not_entities(spark):
    """400 listings and 400 entities of one name: each listing meets one row of the name's counts, not all entities of it."""
    listings = spark.range(400).selectExpr("concat('L', id) AS symbol", "'N' AS name_key", "if(id % 2 = 0, 'C1', 'C2') AS country")
    found = spark.range(400).selectExpr("concat('E', id) AS lei", "'N' AS name_key", "if(id % 4 = 3, 'LAPSED', 'ACTIVE') AS state", "if(id = 0, 'C1', 'C2') AS legal_country", "array('C1X', 'C2Y') AS isins")
    got = chain.name_anchors(listings, found)
    assert {(r.entity_lei, r.status) for r in got.where("symbol IN ('L0', 'L1')").collect()} == {("E0", "confirmed"), (None, "ambiguous")}
    rows = _join_rows(got)
    assert rows and max(rows) <= 400


def test_last_gate_runs_once(spark):
    """What the last gate attached and what it refused come from one pass: one aggregation of foreign issuers."""
    listings = spark.createDataFrame(ROWS, LISTED)
    candidates = spark.createDataFrame([], "symbol string, place int, lei string, legal_name string, legal_country string, headquarters_country string, jurisdiction string")
    expansions = spark.createDataFrame([], "lei string, expansion_status string, isins array<string>")
    out = waterfall.waterfall(listings, [("issuer", lambda rows: waterfall.foreign_issuers(rows, candidates.repartition(2), expansions.repartition(2)))])
    assert {(r.entity_lei, r.method) for r in out.collect()} == {(None, "unattached")}
    assert out._jdf.queryExecution().analyzed().toString().count("Aggregate [") == 1
