"""Vendor rules (priority), fuzzy threshold, and exactness of the bigram candidate search."""


from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.operators.vendors import canonical_table, fuzzy_name_map, vendor_fuzzy_match, vendor_rule_map

RULES = (("SUMMIT", "Summit Concrete Inc."), ("SUMMIT MECH", "Summit Mechanical LLC"), ("ACME", "Acme Steel"))


def test_rule_priority_and_no_match(spark):
    df = spark.createDataFrame([("Summit Mechanical",), ("summit concrete",), ("Other Co",), (None,)], "v string")
    got = [r.v for r in vendor_rule_map(df, "v", rules=RULES).collect()]
    assert got == ["Summit Mechanical LLC", "Summit Concrete Inc.", "Other Co", None]


def _levenshtein(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def _key(s):
    """Independent of the operator: Unicode decomposition and character classes."""
    import unicodedata
    plain = "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c))
    spaced = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in plain.replace(".", "").replace("'", ""))
    return " ".join(sorted(spaced.split()))


def _brute(names, canonical, threshold=85.0):
    out = {}
    for n in names:
        nk, best = _key(n), None
        for i, c in enumerate(canonical):
            ck = _key(c)
            longest = max(len(nk), len(ck))
            score = 100.0 * (1.0 - _levenshtein(nk, ck) / longest) if nk and ck else 0.0
            if score >= threshold and (best is None or score > best[0]):
                best = (score, c)
        if best:
            out[n] = best[1]
    return out


def test_threshold_edge(spark):
    # 20-char keys: 3 edits -> 85.0 (accepted), 4 edits -> 80.0 (rejected)
    canon = ["abcdefghijklmnopqrst"]
    names = ["abcdefghijklmnopqxyz", "abcdefghijklmnopwxyz", "tsrq ponm"]
    got = {r.raw_name: r.matched for r in fuzzy_name_map(
        spark.createDataFrame([(n,) for n in names], "raw_name string"), canonical_table(spark, canon)).collect()}
    assert got == _brute(names, canon)
    assert "abcdefghijklmnopqxyz" in got and "abcdefghijklmnopwxyz" not in got


def test_rules_then_fuzzy(spark):
    vals = ["Summit Mech.", "Acmee Steel", "Steel, Acme", "Zenith", None]
    df = spark.createDataFrame(list(enumerate(vals)), "id int, v string")
    out = vendor_fuzzy_match(df, "v", rules=RULES, canonical=["Acme Steel", "Summit Mechanical LLC"])
    got = [r.v for r in out.orderBy("id").collect()]
    assert got == ["Summit Mechanical LLC", "Acme Steel", "Acme Steel", "Zenith", None]


words = st.text(alphabet="abcdeé東 .-'", min_size=0, max_size=14)


@settings(max_examples=15, deadline=None)
@given(st.lists(words, min_size=1, max_size=12, unique=True), st.lists(words, min_size=1, max_size=6, unique=True))
def test_candidate_search_is_exact(spark, names, canonical):
    names_df = spark.createDataFrame([(n,) for n in names], "raw_name string")
    got = {r.raw_name: r.matched for r in fuzzy_name_map(names_df, canonical_table(spark, canonical), 70.0).collect()}
    canon_u = list(dict.fromkeys(canonical))
    assert got == _brute(names, canon_u, 70.0)


def test_default_rules_then_fuzzy(spark):
    """Every canonical name, in upper case, with its last two letters swapped, and its words turned round."""
    from ledgerlens.operators.vendors import DEFAULT_VENDOR_RULES
    targets = list(dict.fromkeys(c for _, c in DEFAULT_VENDOR_RULES))
    spellings = [(c, v) for c in targets for v in (c, c.upper(), c[:-2] + c[-1] + c[-2], " ".join(reversed(c.split())))]
    df = spark.createDataFrame([(i, v) for i, (_, v) in enumerate(spellings)], "id int, v string")
    ruled = {r.id: r.v for r in vendor_rule_map(df, "v").collect()}
    fuzzy = {r.id: r.v for r in vendor_fuzzy_match(df, "v").collect()}
    want = _brute([v for _, v in spellings], targets)
    for i, (_, v) in enumerate(spellings):
        assert fuzzy[i] == (ruled[i] if ruled[i] in targets else want.get(v, v)), v
