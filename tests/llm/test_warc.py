import hashlib
import random

import pytest
from oracle_check import connect, differences

from tallyloom.llm.warc import candidates, read_pages, read_records, write_pages

SCHEMA = "page_id long, url string, html string, record_type string"


def brute(rows):
    last = {}
    for i, _, h, _ in rows:
        if len((h or "").encode()) >= 1000:
            last[h] = max(last.get(h, -(2**63)), -(2**63) if i is None else i)
    out = []
    for i, _, h, _ in rows:
        data = (h or "").encode()
        to = last.get(h)
        revisit = to is not None and (i is None or i < to) and to != -(2**63)
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def ours(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def pages():
    rng = random.Random(1)
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    rows = []
    for i in range(150):
        body = "".join(rng.choice("abc é\n") for _ in range(rng.choice([0, 10, 990, 1500])))
        inner = "x" * rng.randint(0, 50)
        body += "".join(fake % (rng.choice([len(inner), 5, 3000, 10**9]), inner) for _ in range(rng.randint(0, 4)))
        rows.append((i, f"http://h{i % 7}/é ü?{i}%20", body, "c"))
    same = "same payload, long enough " * 60
    rows += [(1000 + i, None, same, None) for i in range(30)]
    rows += [(2000, "u", None, "x"), (2001, "a\r\nb", "", "x"), (None, None, same, None), (None, "u", "tiny", None), rows[3], rows[160], (2002, "u", "z" * 999, ""), (2003, "u", "z" * 999, "")]
    return rows + [(3000, "long", "WARC/1.1\r\n" * 40000, "")]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("block_bytes", [700, 1 << 20])
def test_round_trip_and_magic_inside_payloads(spark, packed, block_bytes):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    files = write_pages(df, packed=packed)
    assert ours(read_pages(files, block_bytes)) == brute(rows)
    html = {r.page_id: r.html for r in read_pages(files, block_bytes).collect() if r.record_type == "response" and r.page_id is not None}
    assert all(html[i] == (h or "") for i, _, h, _ in rows if i in html)
    if not packed:
        assert candidates(files, block_bytes).count() > read_records(files, block_bytes).count() == len(rows)


def test_broken_chain_is_an_error(spark, tmp_path):
    files = write_pages(spark.createDataFrame([(1, "u", "abc" * 900, "")], SCHEMA), packed=False, folder=str(tmp_path / "w"))
    name = files.first().file.removeprefix("file:")
    data = open(name, "rb").read()
    open(name, "wb").write(data[:-5])
    with pytest.raises(Exception):
        read_records(files).collect()


def test_empty_table(spark):
    assert read_pages(write_pages(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(spark, connect(sf), sf, "op8_warc_pages") == []
