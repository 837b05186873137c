import hashlib
import io
from datetime import datetime, timezone

import pyarrow.fs as pafs
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from clickledger.llm.mixing import mix_sources
from clickledger.llm.warc import (
    Layout, archive_folder, find_record, open_archive, parse_records, payload_of, read_archive, read_frame, read_record_map,
    read_seek_table, write_archive,
)

SMALL = Layout(frame=3000, bundle=4000)


def opened(bundle):
    filesystem, path = pafs.FileSystem.from_uri(bundle) if "://" in bundle else (pafs.LocalFileSystem(), bundle)
    return filesystem.open_input_file(path)


def pages_of(spark):
    big = "<p>" + "ä long page " * 200
    rows = [(i, f"http://x/{i}", f"<p>page {i}" + "text " * (i % 7) * 60) for i in range(60)]
    rows += [(100, "http://x/a", big), (101, "http://x/b\r\nEvil: 1", big), (102, None, big), (103, "u", None), (104, "u", ""),
             (105, "u", "short"), (106, "u", "short"), (None, "u", big), (100, "http://x/a", big), (107, "u", "y" * 200_000)]
    return spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")


def test_round_trip(spark):
    pages = pages_of(spark)
    index = write_archive(pages, archive_folder(pages), SMALL)
    assert index.count() == pages.count() and index.select("bundle").distinct().count() > 1
    got = sorted(map(tuple, read_archive(index).collect()), key=repr)
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    want = []
    for page, payload in rows:
        holder = max(p for p, x in rows if x == payload and p is not None)
        again = page is not None and len(payload) >= 1000 and page < holder
        want.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", holder if again else None))
    assert got == sorted(want, key=repr)


def test_one_record_from_one_frame(spark):
    pages = pages_of(spark)
    index = write_archive(pages, archive_folder(pages), SMALL)
    (fields, block), = find_record(index, 107)
    assert payload_of(block) == b"y" * 200_000 and fields["WARC-Target-URI"] == "u"
    (fields, block), = find_record(index, 101)
    named = index.filter("page_id = 102").first()["record"]
    assert block == b"" and fields["WARC-Type"] == "revisit" and fields["WARC-Refers-To"] == f"<{named}>"
    assert "Evil" not in fields and fields["WARC-Target-URI"] == "http://x/b%0D%0AEvil: 1"


def test_records_have_what_the_format_asks_for(spark):
    pages = pages_of(spark)
    folder = archive_folder(pages)
    index = write_archive(pages, folder, SMALL, written_at=datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc))
    names, targets = set(), []
    for bundle, in index.select("bundle").distinct().collect():
        file = opened(bundle)
        known = read_record_map(file)
        for number, (offset, packed, full) in enumerate(read_seek_table(file)):
            for place, fields, block in parse_records(read_frame(file, offset, packed, full)):
                name = fields["WARC-Record-ID"].strip("<>")
                assert name not in names and known[name] == (number, place)
                names.add(name)
                assert fields["WARC-Date"] == "2024-05-06T07:08:09Z" and fields["WARC-Target-URI"]
                assert int(fields["Content-Length"]) == len(block)
                if fields["WARC-Type"] == "response":
                    assert fields["Content-Type"] == "application/http; msgtype=response"
                    assert block.startswith(b"HTTP/1.1 200 OK\r\n")
                else:
                    targets.append(fields["WARC-Refers-To"].strip("<>"))
    assert len(names) == pages.count() and targets and set(targets) <= names
    # the index lies beside the bundles
    assert sorted(open_archive(spark, folder).select("record").collect()) == sorted((n,) for n in names)


def test_bundles_are_plain_zstandard_with_a_seek_table(spark):
    pages = pages_of(spark)
    index = write_archive(pages, archive_folder(pages), SMALL)
    for bundle, in index.select("bundle").distinct().collect():
        data = opened(bundle).readall()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        table = read_seek_table(opened(bundle))
        assert sum(full for _, _, full in table) == len(whole)
        assert len(list(parse_records(whole))) == index.filter(F.col("bundle") == bundle).count()


def test_no_pages(spark):
    none = pages_of(spark).filter("false")
    assert read_archive(write_archive(none, archive_folder(none))).count() == 0


def test_stages_on_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == corpus_pipeline.DOCUMENT, name
            assert out.dtypes == docs.select(*corpus_pipeline.DOCUMENT).dtypes, name
            out.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, "").count()


def test_stages_take_effect(spark):
    en = "the house of the king was on that hill and the people went to it with joy and song "
    rows = [(i, f"{en} number {i} {'word' * i} mail a{i}@b.org {en.upper()}", "en", "ab"[i % 2], 1) for i in range(1, 9)]
    rows += [(20, "1234 !!", "en", "a", 7), (21, None, "en", "a", 0), (30, rows[0][1], "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    told = stages["language_id"](spark, docs, "")
    assert {r["doc_id"] for r in told.collect()} == {*range(1, 9), 30}
    single = stages["near_dedup"](spark, docs, "")
    assert 30 not in {r["doc_id"] for r in single.collect()} and single.filter("doc_id IN (1, 20, 21)").count() == 3
    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages["personal_data"](spark, docs, "").collect()}
    assert all("@" not in (t or "") and n == (t and len(t)) for t, n in masked.values()) and "<EMAIL>" in masked[1][0]
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(docs).collect()}
    mixed = [r["doc_id"] for r in stages["mix"](spark, docs, "").collect()]
    assert all(mixed.count(i) == n for i, n in copies.items())
    packed = stages["packing"](spark, docs, "").collect()
    assert {r["doc_id"] for r in packed} == {r[0] for r in rows}


def test_run_on_a_small_folder(spark, documents):
    from .conftest import FOLDER

    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() > 0 and {"doc_id", "batch", "text"} <= set(out.columns)
