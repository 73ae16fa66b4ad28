"""Records inside members of several records, whole streams and damaged members."""

import io
import random
import time
import zlib

from gristmill.llm import warc

RECORDS = [warc.make_record(k, f"https://a.b/{k}", random.Random(k).randbytes(50) * (k % 7 + 1) + b" text %d" % k) for k in range(100)]
PAYLOADS = [random.Random(k).randbytes(50) * (k % 7 + 1) + b" text %d" % k for k in range(100)]


def read(data):
    found = list(warc.salvage(io.BytesIO(data)))
    return [x.payload for x in found if isinstance(x, warc.Record)], [x for x in found if isinstance(x, warc.Gap)]


def test_a_member_of_several_records():
    for n in (2, 100):
        assert read(warc.gzip_member(b"".join(RECORDS[:n]))) == (PAYLOADS[:n], [])
    both = warc.gzip_member(RECORDS[0] + RECORDS[1]) + warc.gzip_member(RECORDS[2]) + RECORDS[3]
    assert read(both) == (PAYLOADS[:4], [])


def test_a_damaged_record_in_a_stream_costs_that_record():
    for k in (0, 1, 50, 99):
        for where in (0, -20):  # version line, block
            bad = bytearray(RECORDS[k])
            bad[where] ^= 0xFF
            payloads, gaps = read(warc.gzip_member(b"".join([*RECORDS[:k], bytes(bad), *RECORDS[k + 1 :]])))
            assert payloads == PAYLOADS[:k] + PAYLOADS[k + 1 :]
            start = sum(map(len, RECORDS[:k]))
            assert [g.inside for g in gaps] == [(start, start + len(bad))]


def test_a_damaged_member_gives_what_comes_before_the_damage():
    whole = warc.gzip_member(b"".join(RECORDS))
    after = warc.gzip_member(RECORDS[7])
    rng = random.Random(1)
    for cut in [len(whole) - 3, *(rng.randrange(100, len(whole)) for _ in range(15))]:
        safe = zlib.decompressobj(31).decompress(whole[:cut])
        n, size = 0, 0
        while n < 100 and (size := size + len(RECORDS[n])) < len(safe):
            n += 1
        payloads, gaps = read(whole[:cut])
        assert payloads == PAYLOADS[:n] and gaps[-1].end == cut
        payloads, gaps = read(whole[:cut] + after)
        assert payloads[:n] == PAYLOADS[:n] and payloads[-1] == PAYLOADS[7] and len(gaps) == 1
    flipped = bytearray(whole)
    flipped[len(whole) // 2] ^= 0x10
    payloads, gaps = read(bytes(flipped) + after)
    assert payloads[:-1] == PAYLOADS[: len(payloads) - 1] and 30 < len(payloads) < 60 and payloads[-1] == PAYLOADS[7] and gaps


def test_false_heads_take_linear_time():
    for junk in (b"\x1f\x8b\x08" * 3_400_000, b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" * 30_000, (b"\nWARC/1.0\r\n" + b"\x1f\x8b\x08\x00") * 50_000):
        began = time.perf_counter()
        payloads, gaps = read(junk + b"\r\n" + RECORDS[0])
        assert payloads == PAYLOADS[:1] and len(gaps) == 1 and time.perf_counter() - began < 10
