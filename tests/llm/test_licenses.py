"""License scans against a plain version of rules and suppression, and on long texts."""

import random
import re
import time

from rollbook.llm import licenses


def brute(text):
    words = re.split(licenses.GAP, (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    form = " " + " ".join(w for w in words if w) + " "
    span = lambda m: (form[:m.start()].count(" ") - 1, form[:m.start()].count(" ") - 1 + m.group().count(" "))
    places = lambda p: [span(m) for m in re.finditer(f"(?<= )(?:{p})(?= )", form)]
    base = sorted((a, b, label, 50, -1) for p, label in licenses.BASE.items() for a, b in places(p))
    hinted = any(f" {w} " in form for w in licenses.HINTS)
    hits = {(a, b, r["label"], r["priority"], r["number"]) for r in licenses.rules()
            if (hinted or not r["hint"]) and f" {r['keyword']} " in form for a, b in places(r["pattern"])}

    def beats(y, x):
        if y[:2] == x[:2]:
            return y[3] > x[3] or (y[3] == x[3] and y[4] < x[4])
        return y[0] <= x[0] and y[1] >= x[1] and y[3] >= x[3]

    return base, sorted(base + [x for x in hits if not any(beats(y, x) for y in hits)])


def test_detections_equal_a_plain_version(spark):
    rng = random.Random(5)
    parts = ["MIT license", "apache license", "version 2 0", "GNU General Public License", "v3", "or later", "licensed under the terms of the", "gpl", "lgpl 2.1", "bsd 3-clause license", "text", "file",
             "all rights reserved", "released into the public domain", "mozilla public license 2.0", "spdx-license-identifier: mit", "this", "boost software license", "x11", "the unlicense"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(60)] + ["mit license " * 300, None, "", "?!", "Apache License\n\nVersion 2.0"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in licenses.scan(rows).collect()}
    for k, t in enumerate(texts):
        base, detections = brute(t)
        assert [tuple(x) for x in got[k]["base"]] == base, t
        assert [tuple(x) for x in got[k]["detections"]] == detections, t


def test_a_very_long_text_of_many_places(spark):
    rows = spark.createDataFrame([(1, "MIT license text " * 20_000)], "doc_id bigint, text string")
    began = time.time()
    r = licenses.scan(rows).selectExpr("n_words", "size(base) AS b", "size(detections) AS d", "base[19999].first AS at").first()
    assert tuple(r) == (60_000, 20_000, 40_000, 59_997)
    assert time.time() - began < 100  # a quadratic scan takes far longer
