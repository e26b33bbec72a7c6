import hashlib

from pyspark.sql import functions as F

from tillwork.llm import fixity

SCHEMA = "file string, offset long, length long, digest string"


def records(spark, files, change=None):
    """Records of 100 to 140 bytes one behind the other in each file."""
    rows = []
    for f, n in files.items():
        at = 0
        for i in range(n):
            body, length = f"{f}/{i}", 100 + i % 5 * 10
            if change:
                body, length = change(f, i, body, length)
            if body is None:
                continue
            rows.append((f, at, length, hashlib.sha256(body.encode()).hexdigest()))
            at += length
    return spark.createDataFrame(rows, SCHEMA), {r[:2]: r[2:] for r in rows}


def check(spark, files, change, **options):
    a, one = records(spark, files)
    b, other = records(spark, files, change)
    found = {(r.file, r.offset): r.state for r in fixity.audit(a, b, **options).collect()}
    expected = {k: "missing" if k not in other else "extra" if k not in one else "altered"
                for k in {*one, *other} if one.get(k) != other.get(k)}
    assert found == expected
    return expected


FILES = {"a": 200, "b": 3, "c": 57, None: 9, "e": 1}


def test_damage_is_located(spark):
    small = {"leaf_bytes": 500, "fanout": 3}
    assert not check(spark, FILES, None, **small)
    assert len(check(spark, FILES, lambda f, i, b, n: (b + "x" * (i in (7, 199) and f == "a"), n), **small)) == 2
    cut = check(spark, FILES, lambda f, i, b, n: (b, n - (f == "c" and i == 50)), **small)
    assert set(cut.values()) == {"altered", "missing", "extra"}
    assert set(check(spark, FILES, lambda f, i, b, n: (None if f == "b" else b, n), **small).values()) == {"missing"}


def test_one_side_empty_and_repeated_records(spark):
    a, one = records(spark, {"a": 5})
    none = spark.createDataFrame([], SCHEMA)
    assert {r.state for r in fixity.audit(a, none).collect()} == {"missing"}
    assert {r.state for r in fixity.audit(none, a).collect()} == {"extra"}
    assert fixity.audit(none, none).count() == 0
    assert {r.state for r in fixity.audit(a, a.unionByName(a.limit(1))).collect()} == {"extra"}


def test_equal_replicas_have_equal_roots(spark):
    a, _ = records(spark, FILES)
    numbers, levels = fixity.file_numbers([a]), fixity.shape([a], 500, 3)
    one, other = (fixity.build(x, numbers, levels, 500, 3) for x in (a, a.repartition(7)))
    assert one.root() == other.root() and len(one.root()) == 64
    assert one.over[-1].count() == 1


def test_only_differing_branches_are_entered(spark):
    a, _ = records(spark, {"a": 500, "b": 500})
    b, _ = records(spark, {"a": 500, "b": 500}, lambda f, i, x, n: (x + "!" * (f == "b" and i == 400), n))
    numbers, levels = fixity.file_numbers([a, b]), fixity.shape([a, b], 500, 4)
    one, other = (fixity.build(x, numbers, levels, 500, 4) for x in (a, b))
    leaves = fixity.differing_leaves(one, other, numbers, 4).collect()
    assert [r.file for r in leaves] == ["b"] and len(leaves) == 1


def test_records_are_laid_out(spark):
    pages = spark.createDataFrame([(2, "u2", "text"), (1, "u1", None), (1, "u1", None), (None, None, "ü")],
                                  "page_id long, url string, html string")
    out = fixity.laid_out(pages, fixity.warc_record(F.col("url"), F.col("html"), F.col("page_id")),
                          F.lit("f"), ["page_id"]).orderBy("offset").collect()
    at = 0
    for r in out:
        assert r.offset == at
        at += r.length
    assert [r.page_id for r in out] == [None, 1, 1, 2]
    record = pages.filter("page_id = 2").select(fixity.warc_record(
        F.col("url"), F.col("html"), F.col("page_id")).alias("r")).first().r
    head, _, body = bytes(record).partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\n") and b"Content-Length: 4" in head and body == b"text\r\n\r\n"


def told_by_id(spark, change, **options):
    """What is found wrong when records carry ids, as id: state, after ``change`` of the list of (id, text, length)."""
    sides = []
    for files in ({f: [(i, f"{f}/{i}", 100 + i % 5 * 10) for i in range(n)] for f, n in FILES.items()},) * 2:
        rows = []
        for f, records in files.items():
            at = 0
            for i, text, length in change(f, list(records)) if sides else records:
                rows.append((f, at, length, hashlib.sha256(text.encode()).hexdigest(), i))
                at += length
        sides.append(rows)
    ids = [{(r[0], r[1]): r[4] for r in side} for side in sides]
    one, other = (spark.createDataFrame(s, SCHEMA + ", id long") for s in sides)
    return sorted((r.file or "", ids[r.state == "extra"][r.file, r.offset], r.state)
                  for r in fixity.audit(one, other, 500, 3, record=["id"], **options).collect())


def test_only_damaged_records_are_named(spark):
    def change(f, records):
        if f == "a":
            i, text, n = records[20]
            records[20] = (i, text + "cut", n - 7)
            i, text, n = records[150]
            records[150] = (i, text + "?", n)
            del records[60]
            records.insert(100, (999, "new", 33))
        return records[1:] if f == "c" else records
    assert told_by_id(spark, change) == [
        ("a", 20, "altered"), ("a", 60, "missing"), ("a", 150, "altered"), ("a", 999, "extra"), ("c", 0, "missing")]
    assert told_by_id(spark, lambda f, records: records) == []


def test_repeated_records_by_id(spark):
    twice = lambda f, records: records[:5] + records[4:] if f == "a" else records
    assert told_by_id(spark, twice) == [("a", 4, "extra")]
    swapped = lambda f, records: [records[1], records[0], *records[2:]] if f == "a" else records
    assert told_by_id(spark, swapped) == []
