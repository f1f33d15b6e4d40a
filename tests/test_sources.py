import base64
import gzip
import json

import pytest
from pyspark.sql import functions as F

from nameharbor.operators import ct, snapshots
from nameharbor.operators.selections import filter_logs, mark_finished, read_finished, reset_finished, without_finished
from nameharbor.sources import certificates, passive, warehouse, zones

LINE = "{}.test.   3600  in  ns  dns.example.test.\n"


@pytest.fixture
def snapshot_dir(tmp_path):
    for date, owners in {
        "2021-01-31": ["example"], "2021-02-01": ["example"], "2021-02-02": ["example", "example2"],
        "2021-02-03": ["example"], "2021-02-04": ["example"],
    }.items():
        with gzip.open(tmp_path / f"test.{date}.gz", "wt") as out:
            out.writelines(LINE.format(o) for o in owners)
    for misnamed in ("co.uk.2021-02-01.gz", "test.2021-02.gz", "notes.gz"):
        with gzip.open(tmp_path / misnamed, "wt") as out:
            out.write(LINE.format("wrong"))
    return str(tmp_path)


def test_snapshot_listing(spark, rows, snapshot_dir):
    files = zones.snapshot_files(spark, snapshot_dir, "2021-02-01", "2021-02-03")
    assert rows(files, "tld", F.col("snapshot_date").cast("string")) == [
        ("test", "2021-02-01"), ("test", "2021-02-02"), ("test", "2021-02-03")]
    assert files.where("tld = 'com'").count() == 0


def test_events_of_snapshot_files(spark, rows, snapshot_dir):
    window = ("2021-02-01", "2021-02-03")
    found, bad = zones.read_snapshots(spark, snapshot_dir, *window)
    assert bad.count() == 0
    fast, _ = zones.read_snapshots(spark, snapshot_dir, *window, default=zones.absolute_reader)
    assert rows(fast) == rows(found)
    events = snapshots.zone_diff_events(found, zones.snapshot_files(spark, snapshot_dir, *window))
    assert rows(events, "domain", "event_type", F.col("snapshot_date").cast("string")) == [
        ("example.test", "FIRST_SEEN", "2021-02-01"), ("example2.test", "EXPIRATION", "2021-02-03"),
        ("example2.test", "REGISTRATION", "2021-02-02"),
    ]


def test_list_in_another_charset(spark, rows, tmp_path):
    with gzip.open(tmp_path / "dk.2021-02-01.gz", "wb") as out:
        out.write("blåbær.dk\nøl.dk\n".encode("iso-8859-1"))
    found, _ = zones.read_snapshots(spark, str(tmp_path))
    assert rows(found, "tld", "domain") == [("dk", "blåbær.dk"), ("dk", "øl.dk")]
    upper = zones.list_domains(spark, str(tmp_path), decode=F.upper)
    assert rows(upper, "domain") == [("BLÅBÆR.DK",), ("ØL.DK",)]


def test_record_types(spark, rows, tmp_path):
    lines = [
        "First.org. 3600 IN NS ns.x.", "first.org. IN 3600 NS ns2.x.", "third.net. A 1.2.3.4", "fourth.net. 1h AAAA ::1",
        'text.net. 60 in txt "a;b" ; note', "net. 60 in ns x.", "; comment", "", "broken",
    ]
    (tmp_path / "net.2021-02-01.zone").write_text("\n".join(lines))
    good, bad = zones.split_rejects(zones.absolute_records(zones.record_lines(spark, str(tmp_path))))
    assert rows(zones.zone_domains(good), "domain") == [("first.org",), ("fourth.net",), ("third.net",)]
    assert rows(zones.snapshot_domains(good), "domain") == [("first.org",), ("fourth.net",), ("text.net",), ("third.net",)]
    assert rows(good.where("rr_type = 'TXT'"), "rdata") == [('"a;b"',)]
    assert rows(bad, "reason", "payload") == [("unreadable record", "broken")]


MASTER = """$ORIGIN com.
$TTL 900
@ in soa ns.x. admin.x. (
    1 ; serial (first)
    2 3 4 5 )
 ns ns.x.
example ns a.x.
    ns b.x.
www.example a 1.2.3.4
$ORIGIN sub.example.com.
host 60 in aaaa ::1
absolute.com. ns c.x.
"""
OWNERS = ["com", "com", "example.com", "example.com", "www.example.com", "host.sub.example.com", "absolute.com"]


def test_master_file(spark, tmp_path):
    (tmp_path / "com.2021-02-01.zone").write_text(MASTER)
    found = zones.master_file_records(zones.record_lines(spark, str(tmp_path)))
    assert [r.owner for r in found.collect()] == OWNERS


def test_any_zone_file_by_default(spark, rows, tmp_path):
    (tmp_path / "com.2021-02-01.zone").write_text(MASTER + "broken\n")
    (tmp_path / "own.2021-02-01.zone").write_text("whatever")
    own = lambda session, path, start, end, wanted: (
        session.sql("SELECT 'own' AS tld, DATE'2021-02-01' AS snapshot_date, 'a.own' AS domain"),
        zones.list_reader(session, path, start, end, wanted)[1],
    )
    found, bad = zones.read_snapshots(spark, str(tmp_path), readers={"own": own})
    assert rows(found, "domain") == sorted({(o,) for o in OWNERS if o != "com"} | {("a.own",)})
    assert rows(bad, "tld", "reason", "payload") == [("com", "unreadable record", "broken")]
    with pytest.raises(Exception, match="not an absolute record"):
        zones.read_snapshots(spark, str(tmp_path), readers={"own": own}, default=zones.absolute_reader)[0].collect()


@pytest.mark.parametrize("size", [40, 64, 100])
def test_master_file_in_many_splits(spark, tmp_path, size):
    """State crosses file splits: every split size gives the same records."""
    body = MASTER + "\n".join(f"d{i} ns x.\n  ns y." for i in range(40)) + "\n"
    (tmp_path / "com.2021-02-01.zone").write_text(body)
    whole = zones.master_file_records(zones.record_lines(spark, str(tmp_path))).select("owner", "rr_type", "rdata")
    expected = sorted(map(tuple, whole.collect()))
    assert len(expected) == len(OWNERS) + 80
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = zones.record_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3
        split = zones.master_file_records(lines).select("owner", "rr_type", "rdata")
        assert sorted(map(tuple, split.collect())) == expected
    finally:
        for key, value in keep.items():
            spark.conf.set(key, value)


def test_landing_and_reading_back(spark, rows, tmp_path):
    lines = spark.createDataFrame(
        [("com", "2021-02-01", "a.com. in ns x."), ("com", "2021-02-02", "b.com. in ns x.")],
        "tld string, snapshot_date string, value string",
    )
    zones.land_snapshots(lines, str(tmp_path / "landed"))
    found = zones.snapshot_domains(zones.absolute_records(zones.landed_lines(spark, str(tmp_path / "landed"))))
    assert rows(found, "tld", F.col("snapshot_date").cast("string"), "domain") == [
        ("com", "2021-02-01", "a.com"), ("com", "2021-02-02", "b.com")]
    assert list((tmp_path / "landed").glob("tld=com/snapshot_date=2021-02-01/*.gz"))


def test_passive_logs(spark, rows, tmp_path):
    def line(ts, queries):
        return json.dumps({"preview": False, "offset": 0, "result": {"timestamp": ts, **queries}})

    (tmp_path / "one.json").write_text("\n".join([
        line("2019-07-23T13:08:19.016449Z", {"query{}": "www.a.com", "query_type{}": "A"}),
        line("2019-07-23T13:08:18.216423Z", {"query{}": "b.com", "query_type{}": "A"}),
        "{garbage", line("2019-07-23T13:08:18.216423Z", {}),
    ]))
    (tmp_path / "two.json").write_text("\n".join([
        line("2019-07-23T13:08:22.784554Z", {"query{}": "a.com", "query_type{}": "A"}),
        line("2019-07-23T13:08:23.596449Z", {"query{}": ["a.com", "a.com"], "query_type{}": ["A", "AAAA"]}),
    ]))
    (tmp_path / "skipped.txt").write_text(line("2019-07-23T13:08:22.784554Z", {"query{}": "no.com"}))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "three.json").write_text(line("2019-07-23T13:08:22.784554Z", {"query{}": "no.com"}))
    found, bad = passive.read_passive(spark, str(tmp_path))
    assert rows(found, "query") == [("a.com",), ("a.com",), ("a.com",), ("b.com",), ("www.a.com",)]
    assert found.where("query = 'b.com'").first().ts.microsecond == 216423
    assert found.where("query = 'b.com'").first().ts.day == 24  # a day later
    assert rows(bad, "payload") == [("{garbage",)]


def test_warehouse_rows(spark, rows):
    spark.createDataFrame(
        [("www.example.co.uk", 1), ("a", 2), ("a", 3), ("1.2.3.4", 3), ("help.me", 4)], "qname string, unixtime bigint"
    ).createOrReplaceTempView("queries")
    found = warehouse.from_sql(spark, "SELECT qname, min(unixtime), max(unixtime) FROM queries GROUP BY qname")
    assert rows(found) == [("1.2.3.4", 3, 3), ("a", 2, 3), ("help.me", 4, 4), ("www.example.co.uk", 1, 1)]
    seen = warehouse.as_sightings(found)
    assert rows(seen.where("qname = 'a'"), F.unix_seconds("first_seen"), F.unix_seconds("last_seen")) == [(2, 3)]


def test_pages_cover_all_rows_once(spark, rows, tmp_path):
    names = spark.range(1000).select(F.sha1(F.col("id").cast("string")).alias("qname"), F.col("id").alias("n"))
    expected = sorted(r.qname for r in names.collect())
    assert [r[0] for r in rows(warehouse.page(names, 100, 450), "qname")] == expected[450:550]
    assert [r[0] for r in rows(warehouse.page(names, 300, 900), "qname")] == expected[900:]
    assert rows(warehouse.page(names, 10, 1000)) == []
    from test_lookups import scanned

    laid = warehouse.NamePages(names, str(tmp_path / "pages"), 100)
    for limit, offset in ((100, 0), (100, 450), (300, 900), (10, 1000), (1, 999)):
        assert [r[0] for r in rows(laid.page(limit, offset), "qname")] == expected[offset:offset + limit]
    everything = scanned(laid.page(1000, 0))
    assert everything >= 10 and scanned(laid.page(100, 900)) <= everything - 9


# --- certificates ---


def element(tag, *parts):
    body = b"".join(parts)
    size = len(body)
    if size < 128:
        return bytes([tag, size]) + body
    digits = size.to_bytes((size.bit_length() + 7) // 8, "big")
    return bytes([tag, 0x80 | len(digits)]) + digits + body


def to_be_signed(names, critical=False, padding=0):
    general = element(0x30, *[element(0x82, n.encode()) for n in names], element(0x87, b"\x01\x02\x03\x04"))
    usage = element(0x30, bytes.fromhex("0603551d0f"), element(0x04, b"\x03\x02\x05\xa0"))
    flag = [element(0x01, b"\xff")] if critical else []
    san = element(0x30, bytes.fromhex("0603551d11"), *flag, element(0x04, general))
    fields = [element(0xA0, element(0x02, b"\x02")), element(0x02, b"\x07"), element(0x30, b"\x06\x01\x2a"),
              element(0x30, element(0x04, b"x" * padding))]
    return element(0x30, *fields, element(0xA3, element(0x30, usage, san)))


def certificate(names, **how):
    return element(0x30, to_be_signed(names, **how), element(0x30, b"\x06\x01\x2a"), element(0x03, b"\x00sig"))


@pytest.mark.parametrize("make", [certificate, to_be_signed])
@pytest.mark.parametrize("how", [{}, {"critical": True}, {"padding": 70000}])
def test_names_of_a_certificate(make, how):
    assert certificates.dns_names(make(["camino.example", "*.b.example"], **how)) == ["camino.example", "*.b.example"]


def test_unreadable_certificates():
    whole = certificate(["a.com"])
    assert certificates.dns_names(whole[:-20]) is None
    assert certificates.dns_names(b"") is None
    assert certificates.dns_names(b"no certificate") is None
    assert certificates.dns_names(element(0x30, element(0x30, element(0x02, b"\x01")), b"\x30\x00", b"\x03\x00")) == []


def leaf(ms, kind, der):
    head = b"\x00\x00" + ms.to_bytes(8, "big") + kind.to_bytes(2, "big")
    return base64.b64encode(head + (b"k" * 32 if kind == 1 else b"") + len(der).to_bytes(3, "big") + der + b"\x00\x00").decode()


@pytest.fixture
def pages(tmp_path):
    der, tbs = certificate(["flowers.example"]), to_be_signed(["flowers.example"])
    leaves = [leaf(1502287425649, 0, der), leaf(1502368995784, 0, der), leaf(1502376196240, 1, tbs),
              leaf(1502383396264, 1, tbs), leaf(1502390596223, 1, tbs)]
    for first in range(4):
        entries = [{"leaf_input": x, "extra_data": ""} for x in leaves[first:first + (2 if first == 0 else 1)]]
        start = first if first == 0 else first + 1
        if first:
            entries = [{"leaf_input": leaves[start], "extra_data": ""}]
        (tmp_path / f"entry_{start}_{start + len(entries)}.json").write_text(json.dumps({"entries": entries}, indent=1))
    bad = [{"leaf_input": leaf(5, 7, b"x"), "extra_data": ""}, {"leaf_input": "AAAA", "extra_data": ""}]
    (tmp_path / "entry_90_92.json").write_text(json.dumps({"entries": bad}))
    return str(tmp_path), der, tbs


def test_entry_pages(spark, rows, pages):
    path, der, tbs = pages
    good, bad = certificates.split_leaves(certificates.decode_leaves(certificates.read_entry_pages(spark, path, "log/")))
    found = certificates.with_dns_names(good)
    assert rows(found, "index", F.unix_millis("timestamp"), "entry_type", "is_precert", F.octet_length("raw"), F.array_join("dns_names", ",")) == [
        (0, 1502287425649, 0, False, len(der), "flowers.example"), (1, 1502368995784, 0, False, len(der), "flowers.example"),
        (2, 1502376196240, 1, True, len(tbs), "flowers.example"), (3, 1502383396264, 1, True, len(tbs), "flowers.example"),
        (4, 1502390596223, 1, True, len(tbs), "flowers.example"),
    ]
    assert bytes(good.where("index = 2").first().raw) == tbs
    assert rows(bad, "reason") == [("bad leaf",), ("unsupported entry type",)]

    entries = found.select("log_url", "index", F.col("timestamp").alias("ts"))
    heads = ct.tree_heads(entries)
    at = {"a": 1502376196, "b": 0, "c": 1_900_000_000}
    indexes = ct.indexes_by_time(entries, heads, **{k: F.timestamp_seconds(F.lit(v)) for k, v in at.items()})
    assert rows(indexes) == [("log/", 2, 0, 5)]
    late = ct.scan_from_time(entries, heads, F.timestamp_seconds(F.lit(1502376196)))
    assert rows(late, "index") == [(2,), (3,), (4,)]


def test_entry_pages_of_many_folders(spark, pages, tmp_path):
    """Reading folders by log, and others, any number of times in one process; the shared schema stays."""
    import shutil

    from nameharbor.schemas import ENTRY_PAGE

    before = ENTRY_PAGE.json()
    by_log = tmp_path / "by-log"
    shutil.copytree(pages[0], by_log / "log_url=one", ignore=lambda _, names: [n for n in names if n == "by-log"])
    for _ in range(3):
        assert certificates.read_entry_pages(spark, str(by_log)).where("log_url = 'one'").count() == 7
        assert certificates.read_entry_pages(spark, f"{pages[0]}/entry_*.json", "log/").count() == 7
    assert ENTRY_PAGE.json() == before


def test_log_list(spark, rows, tmp_path):
    logs = [{"description": f"Log {i}", "key": "k", "url": f"log{i}", "maximum_merge_delay": 86400, "operated_by": [i % 2]} for i in range(1, 4)]
    (tmp_path / "logs.json").write_text(json.dumps({"logs": logs, "operators": [{"name": "A", "id": 0}, {"name": "B", "id": 1}]}, indent=2))
    found, operators = certificates.read_log_list(spark, str(tmp_path / "logs.json"))
    assert (found.count(), operators.count()) == (3, 2)
    assert rows(certificates.log_operators(found, operators), "url", "operator") == [("log1", "B"), ("log2", "A"), ("log3", "B")]
    cases = {(True, "included"): 3, (True, "excluded"): 2, (False, "included"): 1, (False, "excluded"): 0}
    for (everything, option), expected in cases.items():
        assert filter_logs(found, everything, **{option: ["log1"]}).count() == expected


def test_finished_tlds(spark, rows, tmp_path):
    path = str(tmp_path / "finished")
    reset_finished(spark, path)
    zone = spark.createDataFrame([("com", 1), ("net", 2)], "tld string, n int")
    assert without_finished(zone, read_finished(spark, path)).count() == 2
    mark_finished(zone.where("tld = 'com'"), path)
    assert rows(without_finished(zone, read_finished(spark, path)), "tld") == [("net",)]
    reset_finished(spark, path)
    assert read_finished(spark, path).count() == 0
