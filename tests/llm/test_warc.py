import gzip
import hashlib
import random

import pytest

from quayside.llm import filestore, warc
from quayside.session import scratch_path


def fixture():
    r = random.Random(1)
    bodies = ["<html>" + "".join(r.choice("abc <>é\r\n") for _ in range(r.randint(80, 400))) for _ in range(20)]
    rows = [(100 + i, f"http://x/{i}", r.choice(bodies)) for i in range(200)]
    rows += [(1, None, None), (2, "u", ""), (3, "u\nv %41", "short"), (4, "", "short"), (9000, "late", bodies[0]), (-5, "early", bodies[1]), (None, "n", bodies[2])]
    rows += [(7, "b", "z" * 150), (7, "a", "z" * 150), (8, "c", "z" * 150), (5000, "long", "é" * 2_000_000)]
    r.shuffle(rows)
    return rows


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    out, used = [], set()
    for i, u, h in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        b = (h or "").encode()
        again = i is not None and len(b) >= 100 and (first[h] != i or (i, h) in used)
        used.add((i, h))
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("target,roll", [(None, 1 << 30), (5000, 1500)])
def test_round_trip_and_types(spark, target, roll):
    rows = fixture()
    pages = spark.createDataFrame([(*x, 1) for x in rows], "page_id long, url string, html string, id int").repartition(5)
    folder = scratch_path(spark, "warc")
    listed = warc.write(pages, folder, roll_bytes=roll, target=target)
    assert sum(m["records"] for m in listed) == len(rows) and (target is None or len(listed) > 10)
    got = warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    back = sorted((tuple(r) for r in warc.read_pages(spark, folder).collect()), key=str)
    assert back == sorted(((i, u or "", h or "") for i, u, h in rows), key=str)


def test_same_rows_give_same_files(spark):
    rows = fixture()
    lists = []
    for n in (2, 7):
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(n)
        lists.append(warc.write(pages, scratch_path(spark, "warc"), target=4000, roll_bytes=2000))
    assert lists[0] == lists[1] and len({m["shard"] for m in lists[0]}) > 5 and max(m["roll"] for m in lists[0]) > 0


def test_files_are_plain_gzip_and_damage_is_found(spark):
    pages = spark.createDataFrame([(1, "http://x/", "body " * 50)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    name = warc.write(pages, folder)[0]["file"]
    data = filestore.read(folder, name)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2
    with filestore.committed(folder, name) as out:
        out.write(warc.info_record(0, 0, 5) + warc.page_record(1, "u", b"one", hashlib.sha256(b"two").hexdigest(), None, 5))
    with pytest.raises(Exception, match="does not match"):
        warc.read(spark, folder).collect()


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.digest(pages, scratch_path(spark, "warc")).collect() == []
