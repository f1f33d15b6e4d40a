import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nameharbor.functions import names, times
from nameharbor.functions.pseudonyms import Anonymizer, identity, with_pseudonyms
from nameharbor.functions.suffixes import _rules_of, reject_reason, suffix_rules, with_domain_parts

SPLITS = [
    (".", "", "", "", ""),
    ("com.", "com", "com", "com", "com"),
    ("co.uk.", "uk", "co.uk", "co.uk", "co.uk"),
    ("example.co.uk.", "uk", "co.uk", "example.co.uk", "example.co.uk"),
    ("www.example.co.uk.", "uk", "co.uk", "example.co.uk", "www.example.co.uk"),
    ("*.gov.bn.", "bn", "gov.bn", "*.gov.bn", "*.gov.bn"),
    ("z7*.gov.bn.", "bn", "gov.bn", "z7*.gov.bn", "z7*.gov.bn"),
    ("www.ck", "ck", "ck", "www.ck", "www.ck"),
    ("a.b.ck", "ck", "b.ck", "a.b.ck", "a.b.ck"),
    ("x.unknowntld", "unknowntld", "unknowntld", "x.unknowntld", "x.unknowntld"),
    ("a.foo.kawasaki.jp", "jp", "foo.kawasaki.jp", "a.foo.kawasaki.jp", "a.foo.kawasaki.jp"),
    ("x.city.kawasaki.jp", "jp", "kawasaki.jp", "city.kawasaki.jp", "x.city.kawasaki.jp"),
    ("WWW.A.Com", "com", "com", "a.com", "www.a.com"),
    (".a.c\tom.", "com", "com", "a.com", "a.com"),
]


def test_name_splits(spark):
    given = spark.createDataFrame([(s[0],) for s in SPLITS], "name string")
    found = with_domain_parts(given, "name", suffix_rules(spark)).collect()
    assert {tuple(r) for r in found} == set(SPLITS)


def by_hand(name, rules):
    """Suffix length by trying every rule on every tail."""
    labels = name.split(".")
    best = 1
    for k in range(1, len(labels) + 1):
        kind = rules.get(".".join(labels[-k:]), 0)
        if kind & 4:
            return k - 1
        if kind & 1:
            best = max(best, k)
        if kind & 2 and len(labels) > k:
            best = max(best, k + 1)
    return best


def test_every_rule_agrees_with_matching_by_hand(spark):
    rules = dict(_rules_of(None, True))
    made = [p + base for base in rules for p in ("", "a.", "b.a.")]
    given = spark.createDataFrame([(n,) for n in made], "name string")
    split = with_domain_parts(given, "name", suffix_rules(spark))
    # list entries may hold capitals outside ASCII; the fqdn column is what was matched
    for row in split.collect():
        labels = row.fqdn.split(".")
        size = min(by_hand(row.fqdn, rules), len(labels))
        assert row.public_suffix == ".".join(labels[-size:]), row
        assert row.apex == ".".join(labels[-(size + 1):]), row


def test_split_moves_no_row(spark):
    given = spark.createDataFrame([("a.com",)], "name string")
    plan = with_domain_parts(given, "name", suffix_rules(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "NestedLoop" not in plan
    assert plan.count("BroadcastHashJoin") >= 5


def test_private_rules_can_be_left_out(spark):
    given = spark.createDataFrame([("me.github.io",)], "name string")
    assert with_domain_parts(given, "name", suffix_rules(spark)).first().apex == "me.github.io"
    assert with_domain_parts(given, "name", suffix_rules(spark, private=False)).first().apex == "github.io"


def test_own_rules(spark):
    given = spark.createDataFrame([("a.b.x.y",)], "name string")
    row = with_domain_parts(given, "name", suffix_rules(spark, "// mine\ny\n*.x.y\n")).first()
    assert (row.public_suffix, row.apex) == ("b.x.y", "a.b.x.y")


@pytest.mark.parametrize("name, expected", [
    ("1.2.3.4", True), ("255.255.255.255", True), ("1.2.3.256", False), ("1.2.3", False), ("1.2.3.4.5", False),
    ("::1", True), ("::", True), ("1:2:3:4:5:6:7:8", True), ("1::2:3:4:5:6:7:8", False), ("2001:db8::8", True),
    ("::ffff:1.2.3.4", True), ("1:2:3:4:5:6:1.2.3.4", True), ("1:2:3:4:5:6:7:1.2.3.4", False), ("::1::", False),
    ("12345::", False), ("fe80::1%eth0", False), ("1:2:3", False), ("a.com", False), ("", False),
])
def test_addresses(spark, name, expected):
    assert spark.range(1).select(names.is_ip(F.lit(name)).alias("x")).first().x is expected


def test_addresses_agree_with_the_standard_library(spark):
    import ipaddress

    rng = random.Random(7)
    made = set()
    while len(made) < 3000:
        made.add("".join(rng.choice("0123:.ff:") for _ in range(rng.randint(2, 16))))

    def known(name):
        try:
            ipaddress.ip_address(name)
            return True
        except ValueError:
            return False

    frame = spark.createDataFrame([(n,) for n in made], "name string")
    for row in frame.select("name", names.is_ip(F.col("name")).alias("ip")).collect():
        # the library refuses octets with leading zeros, which we take
        if not any(len(o) > 1 and o[0] == "0" for o in row.name.replace(":", ".").split(".") if "." in row.name):
            assert row.ip == known(row.name), row


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("aB.\t\n*-", max_size=12), min_size=30, max_size=60))
def test_normalizing(spark, given_names):
    def by_steps(name):
        name = name.removesuffix(".").removeprefix(".").lower()
        return name.replace("\t", "").replace("\n", "")

    frame = spark.createDataFrame([(n,) for n in given_names], "name string")
    for row in frame.select("name", names.normalize_name(F.col("name")).alias("out")).collect():
        assert row.out == by_steps(row.name)


def test_rejects(spark):
    frame = spark.createDataFrame([("1.2.3.4.",), (None,), ("a.com",), ("..a.com",), (".",), ("a..com",), (".a.com.",)], "name string")
    reasons = [r.r for r in frame.select(reject_reason(F.col("name")).alias("r")).collect()]
    gap = "name has an empty label"
    assert reasons == ["name is an IP address", "missing name", None, gap, gap, gap, None]


def test_four_levels_get_four_pseudonyms(spark):
    frame = spark.createDataFrame([("a", "b", "c", "d")], "tld string, public_suffix string, apex string, fqdn string")
    marked = Anonymizer(*[lambda c: F.concat(c, F.lit("(anon)"))] * 4)
    assert with_pseudonyms(frame, marked).first()[4:] == ("a(anon)", "b(anon)", "c(anon)", "d(anon)")
    hashed = with_pseudonyms(frame, Anonymizer.sha256("1", "2", "3", "4")).first()[4:]
    assert hashed == tuple(hashlib.sha256(x.encode()).hexdigest() for x in ("a1", "b2", "c3", "d4"))
    assert with_pseudonyms(frame, Anonymizer()).first()[4:] == ("a", "b", "c", "d")
    assert identity(F.lit(1)) is not None


def test_times_keep_their_milliseconds(spark):
    row = spark.range(1).select(
        times.to_unix_ms(times.from_unix_ms(F.lit(1563887299016))).alias("back"),
        times.to_unix_ms(times.from_unix_s(F.lit(4))).alias("s"),
        times.to_unix_ms(times.shifted(times.from_unix_ms(F.lit(0)))).alias("shifted"),
        times.to_unix_ms(times.shifted(times.from_unix_ms(F.lit(0)), "1 hour")).alias("hour"),
    ).first()
    assert tuple(row) == (1563887299016, 4000, 86_400_000, 3_600_000)


@pytest.mark.parametrize("url, tld", [
    ("https://zones.example/czds/downloads/com.zone", "com"), ("https://zones.example/downloads/xn--p1ai.zone", "xn--p1ai"),
    ("https://zones.example/com.zone", None),
])
def test_download_urls(spark, url, tld):
    assert spark.range(1).select(names.zone_of_download_url(F.lit(url)).alias("x")).first().x == tld
