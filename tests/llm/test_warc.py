import hashlib

import zstandard

from hubbub.llm import warc


def test_round_trip(spark, tmp_path):
    long = "<p>é" * 100
    rows = [(i, f"http://x/{i}", long if i % 3 == 0 else f"<html>{i}</html>" * 20) for i in range(60)]
    rows += [(100, None, None), (101, "http://a b\r\n", ""), (102, "u", "short"), (103, "u", "short"), (0, "again", long), (None, "u", long)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "archives")
    warc.write_archives(table, path, sample_bytes=8_000)
    got = sorted(map(tuple, warc.read_archives(spark, path).collect()), key=repr)
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        revisit = html == long and page != 0
        want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 0 if revisit else None))
    assert got == sorted(want, key=repr)
    # Any reader of the format can read every record alone.
    files = sorted((tmp_path / "archives").glob("part-*"))
    n = 0
    for file in files:
        raw = file.read_bytes()
        assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY_MAGIC
        size = int.from_bytes(raw[4:8], "little")
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size]))
        text = reader.stream_reader(raw[8 + size :], read_across_frames=True).read()
        n += text.count(b"WARC/1.1\r\n")
    assert n == len(rows)


def test_archives_are_bounded_and_stand_alone(spark, tmp_path):
    """One task, many archives; page columns named as the record's own do no harm."""
    rows = [(i, f"http://x/{i}", hashlib.sha512(str(i % 450).encode()).hexdigest() * 4, "kept out", b"?") for i in range(500)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, block binary").coalesce(1)
    path = tmp_path / "archives"
    warc.write_archives(table, str(path), sample_bytes=8_000, dictionary_bytes=2_000, block_bytes=3_000, blocks=4)
    files = sorted(path.glob("part-*"))
    assert len(files) > 3
    found = []
    for file in files:
        raw = file.read_bytes()
        assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY_MAGIC and len(raw) < 2_000 + 4 * (3_000 + 1_000)
        found += [warc.parsed(r)[0] for r in warc.records(raw)]
    assert sorted(map(int, found)) == list(range(500))
    got = warc.read_archives(spark, str(path)).collect()
    assert len(got) == 500 and {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {i: i - 450 for i in range(450, 500)}


def test_no_pages(spark, tmp_path):
    table = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(table, str(tmp_path / "a"))
    (tmp_path / "a").mkdir(exist_ok=True)
    assert warc.read_archives(spark, str(tmp_path / "a")).count() == 0
