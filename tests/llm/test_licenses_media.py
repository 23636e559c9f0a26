import hashlib
import zlib

import numpy as np

from feedloom.llm import licenses, media


def scan(spark, rows):
    return sorted((r.doc_id, r.unit, r.unit_no, r.license) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_whole_texts_notices_and_spellings(spark):
    mit = "MIT Licence\n\nCopyright (c) 2020 Someone\n(c) others\n\n" + licenses._MIT.replace("sublicense", "sub-licence").upper()
    rows = [(1, mit), (2, "code\n\n" + licenses._ISC + "\n"), (3, "words\n  released UNDER the mit licence!\nmore"), (4, "Released under the MIT License. And more"), (5, None), (6, ""), (7, "Licensed under CC BY-NC 4.0.")]
    # The title line of the first is a known notice by itself; the second's two paragraphs are known only together.
    assert scan(spark, rows) == [(1, "document", 0, "MIT"), (1, "line", 0, "MIT"), (1, "paragraph", 0, "MIT"), (1, "paragraphs", 2, "MIT"), (2, "paragraphs", 1, "ISC"), (3, "line", 1, "MIT"), (7, "document", 0, "CC-BY-NC-4.0")]


def test_brute_force_units(spark):
    known = dict(licenses.registry())
    text = "a\n \nLicensed under the Apache License,\nVersion 2.0.\n\n© 2020\nReleased under the MIT License."
    prepared = licenses.canonical
    want = {("paragraph", known.get(licenses.digest(p))) for p in ("Licensed under the Apache License,\nVersion 2.0.", "Released under the MIT License.")} | {("line", "MIT")}
    assert {(u, n) for _, u, _, n in scan(spark, [(1, text)])} == want and prepared("A,  B\nc") == "a b c"


def test_every_known_text_wrapped_inside_of_a_longer_one(spark):
    import textwrap

    several = [(n, t) for n, t in licenses.KNOWN if "\n\n" in t]
    wrap = lambda t: "\n\n".join("\n".join(textwrap.wrap(p, 60, break_on_hyphens=False)) for p in t.split("\n\n"))
    rows = [(k, f"About this.\n\n{wrap(t)}\n\nMore text.") for k, (_, t) in enumerate(several)] + [(99, "a\n\n" + several[0][1][:300]), (None, wrap(several[0][1]))]
    found = {(r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.unit == "paragraphs"}
    assert found >= {(k, n) for k, (n, _) in enumerate(several)} and not [f for f in found if f[0] == 99]
    assert "copyright holder" in licenses.canonical("by the\nCopyright holders and") and licenses.canonical("Copyright 2020 A\nCopyright (c) B\n(c) C") == ""
    repeated = [(1, "MIT License"), (1, "MIT License"), (None, "x\nMIT License")]
    assert len(licenses.scan(spark.createDataFrame(repeated, "doc_id long, text string")).collect()) == 3
    clash = spark.createDataFrame([(1, "MIT License", "u", 5)], "doc_id long, text string, t string, digest int")
    assert [(r.unit, r.license) for r in licenses.scan(clash).collect()] == [("document", "MIT")]
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_media_of_no_rows_null_ids_and_clashes(spark):
    schema = "doc_id long, text string, feature int"
    assert media.media_features(spark.createDataFrame([], schema)).collect() == []
    out = media.media_features(spark.createDataFrame([(None, "a", 1), (None, "a", 2)], schema)).collect()
    assert len(out) == 2 and out[0] == out[1] and out[0].doc_id is None


def test_media_round_trip(spark):
    texts = [None, "", "a", "é" * 288, "x" * 576, "y" * 577, "long " * 40000, "a"]
    out = media.media_features(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in out:
        data = (texts[r.doc_id] or "").encode()
        full = data + b"\xff" * (-len(data) % 576 if data else 576)
        wav = media.to_wav(full)
        assert media.from_wav(wav) == full
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(data), len(full), hashlib.sha256(full).hexdigest())
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(full[-32:]), len(wav), hashlib.sha256(wav).hexdigest())
    rows = {r.doc_id: r for r in out}
    assert rows[2].feature == rows[7].feature and rows[0].feature == rows[1].feature and rows[4].feature != rows[5].feature


def test_fingerprint_by_hand():
    x = np.random.default_rng(1).integers(0, 256, 576 * 4, dtype=np.uint8)
    frames = (x.reshape(4, 576).astype(float) - 128) * np.hanning(576)
    power = np.array([[abs(sum(f * np.exp(-2j * np.pi * k * np.arange(576) / 576))) for k in range(289)] for f in frames])
    low, high = power[:, 2:48].argmax(1) + 2, power[:, 48:].argmax(1) + 48
    want = [(t << 32) | (low[t] << 20) | (high[t] << 8) for t in range(4)]
    want += [(t << 32) | (p[t] << 20) | (q[t + g] << 8) | g for g in (1, 2) for p in (low, high) for q in (low, high) for t in range(4 - g)]
    assert sorted(want) == media.fingerprint(x.tobytes()).tolist()
