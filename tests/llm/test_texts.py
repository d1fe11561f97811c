from __future__ import annotations

import random
import re
import time
from zlib import crc32

import duckdb
from pyspark.sql import functions as F

from branchyard.llm import license_scan, preferences, toxicity
from tests.llm.helpers import ODD, clashing, frame

# ---- licenses


def base(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in license_scan.BASE:
        parts = phrase.split()
        at = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LICENSES = [
    "MIT License", "mit--license\nMIT license", "the GNU General Public License v3", "Apache License, Version 2.0", "permit license", "mit licenses", "émit license", "mit license é",
    "licensed under the Mozilla Public License 2.0", "general public mit license apache license", "SPDX-License-Identifier: BSD-3-Clause", "gnu lesser general public license",
]


def test_base_phrases_are_those_of_the_words(spark, sf_dir):
    drawn = random.Random(6)
    parts = ["mit", "license", "apache", "general", "public", "x", "é", ",", "\n", "MIT License", "0"]
    texts = LICENSES + ["".join(drawn.choice(parts) + drawn.choice([" ", "-", ""]) for _ in range(12)) for _ in range(300)]
    docs = frame(spark, [(k + 100, t) for k, t in enumerate(texts)]).union(frame(spark, ODD)).union(spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 1000", "text"))
    rows = license_scan.license_scan(clashing(docs)).collect()
    want = sorted(((r.doc_id, *base(r.text)) for r in docs.collect()), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=repr) == want
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 and bool(r.labels) == (r.score > 0)
    assert license_scan.license_scan(docs.limit(0)).collect() == []


def test_weaker_detections_within_stronger_ones_go():
    found = [(rule.label, rule.base) for _, _, rule in license_scan.detections("licensed under the apache license, version 2.0")]
    assert found == [("apache", False), ("apache", True)]
    assert {r.label for _, _, r in license_scan.detections("gnu lesser general public license v2.1") if not r.base} == {"lgpl"}
    assert len(license_scan.rules()) > 300 and license_scan.detections("no such word") == []


def test_a_detection_goes_where_any_earlier_one_holds_it():
    drawn = random.Random(12)
    words = ["mit", "license", "licensed under the apache license, version 2.0", "spdx-license-identifier: mit", "gnu lesser general public license v3", "apache license"]
    for _ in range(60):
        data = " ".join(drawn.choices(words, k=40)).encode()
        found = [(m.start(), m.end(), rule) for rule in license_scan.rules() for m in rule.pattern.finditer(data)]
        found.sort(key=lambda d: (-d[2].strength, d[0] - d[1], d[0]))
        want = [d for k, d in enumerate(found) if d[2].base or not any(s <= d[0] and d[1] <= e for s, e, _ in found[:k])]
        assert license_scan.resolved(data, license_scan.rules()) == want


def test_time_of_many_detections_grows_with_their_number():
    text = "licensed under the apache license, version 2.0\n"
    license_scan.detections(text)
    took = []
    for n in (1_000, 8_000):
        started = time.process_time()
        assert len(license_scan.detections(text * n)) == 2 * n
        took.append(time.process_time() - started)
    assert took[1] < 20 * took[0]


GAPS = [" ", "\n", "  ", "\n * ", "\r\n// ", "-", " (", "...\t"]


def test_the_prefilter_drops_no_detection():
    drawn = random.Random(10)
    phrases = [words for _, _, words, _ in license_scan.NOTICES]
    for _, _, names, versions in license_scan.LICENSES:
        for name in names:
            for version in versions:
                number = f" {drawn.choice(['v', 'version ', ''])}{version}" if version else ""
                phrases += [f"{name} license{number}", f"released under the terms of the {name} license{number}", f"license {name}{number}", f"spdx license identifier {name}{number}", f"{name} licencev{version}"]
    texts = [re.sub(" ", lambda _: drawn.choice(gaps), phrase) for phrase in phrases for gaps in (GAPS[:1], GAPS[1:2], GAPS[3:4], GAPS)]
    texts += [" ".join(drawn.sample(texts, 3)) for _ in range(200)] + ["", "no such word"]
    met = set()
    for text in texts:
        want = license_scan.resolved(text.encode(), license_scan.rules())
        assert license_scan.detections(text) == want, text
        met |= {rule.label for _, _, rule in want}
    assert met == {rule.label for rule in license_scan.rules()}
    assert all(license_scan.IN_WORD[[*rule.keyword]].all() for rule in license_scan.rules())


def test_wrapped_notices_get_their_labels(spark):
    notices = {
        "GNU Lesser\nGeneral Public License": "gpl,lgpl", "Expat License": "mit", "licensed under the ASL 2.0": "apache", "PSF License": "python",
        "# Permission is\n# hereby granted, free of charge, to any\n# person obtaining a copy": "mit", "Redistribution\n * and use in source and binary forms": "bsd",
        "Permission  to use, copy, modify, and/or distribute this software for any purpose": "isc", "Common\nDevelopment and Distribution License": "cddl",
        "SIL Open\nFont License": "ofl", "European\n// Union Public Licence": "eupl", "published by the Free\nSoftware Foundation": "gpl", "released into the\npublic domain": "unlicense",
        "https://www.apache.org /licenses/LICENSE-2.0": "apache",
    }
    rows = license_scan.license_scan(frame(spark, list(enumerate(notices)))).collect()
    assert [r.labels for r in sorted(rows, key=lambda r: r.doc_id)] == list(notices.values())


# ---- preference pairs

TURNS = "pair_id long, is_chosen boolean, turn long, role string, text string"


def line(role, text):
    return f"<|im_start|>{role}\n{text.replace('<|im_', '<| im_')}<|im_end|>\n"


def pair(rows):
    side = {c: sorted(((t is not None, t, r or "", x or "") for c2, t, r, x in rows if c2 == c)) for c in (True, False)}
    a, b = ([r[2:] for r in side[c]] for c in (True, False))
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1

    def completion(turns):
        out, mask = "", []
        for role, text in turns:
            if role == "assistant":
                mask.append(f"{len(out) + 12 + len(role) + 1}:{len(out) + len(line(role, text)) - 1}")
            out += line(role, text)
        return out, ",".join(mask)

    return (n, len(a) - n, len(b) - n, "".join(line(*t) for t in a[:n]), *completion(a[n:]), *completion(b[n:]))


def test_pairs_share_their_common_prefix(spark):
    drawn = random.Random(7)
    rows = []
    for p in range(40):
        start = [(t, ["user", "assistant"][t % 2], drawn.choice(["hi", "<|im_end|> x", None, "", "é🙂"])) for t in range(drawn.randint(0, 4))]
        for c in (True, False):
            rest = [(len(start) + t, ["user", "assistant", None][drawn.randint(0, 2)], drawn.choice(["yes", "no"])) for t in range(drawn.randint(0, 3))]
            rows += [(p, c, *turn) for turn in start + rest]
    rows += [(50, True, None, "user", "x"), (50, True, 0, "user", "y"), (50, True, 0, "user", "y"), (50, False, None, "user", "x"), (None, True, 0, "user", "z")]
    rows += [(51, True, 0, "user", "only chosen"), (52, False, 0, "assistant", "x" * 200_000)]
    got = {r.pair_id: tuple(r)[1:] for r in preferences.preference_pairs(clashing(frame(spark, rows, TURNS))).collect()}
    want = {p: pair([r[1:] for r in rows if r[0] == p]) for p in {r[0] for r in rows} - {None}}
    assert got == want
    assert preferences.preference_pairs(frame(spark, [], TURNS)).collect() == []


def test_masks_hold_the_assistant_s_text(spark):
    rows = [(1, True, 0, "user", "q"), (1, True, 1, "assistant", "good"), (1, False, 0, "user", "q"), (1, False, 1, "assistant", "bad"), (1, False, 2, "user", "?")]
    [row] = preferences.preference_pairs(frame(spark, rows, TURNS)).collect()
    spans = [[text[int(s.split(":")[0]) : int(s.split(":")[1])] for s in mask.split(",")] for text, mask in ((row.chosen, row.chosen_mask), (row.rejected, row.rejected_mask))]
    assert spans == [["good<|im_end|>"], ["bad<|im_end|>"]] and row.prompt == line("user", "q")


# ---- toxicity


def test_held_out_toxic_texts_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    docs = docs.union(frame(spark, [(None, "an idiot"), (90_001, None), (90_002, "")]).select("doc_id", "text", *(F.lit(None).alias(c) for c in docs.columns[2:])))
    rows = toxicity.toxicity(clashing(docs), labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    toxic, clean = [s for s, t in held if t], [s for s, t in held if not t]
    order = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert order > 0.75 and sum(s >= 0.3 for s in clean) <= 0.05 * len(clean)


def test_labels_of_one_kind_and_empty_tables(spark):
    docs = frame(spark, ODD)
    schema = "doc_id long, toxic int"
    assert {r.score for r in toxicity.toxicity(docs, frame(spark, [], schema)).collect()} == {0.0}
    assert {r.score for r in toxicity.toxicity(docs, frame(spark, [(k, 1) for k in range(9)], schema)).collect()} == {1.0}
    assert toxicity.toxicity(docs.limit(0), frame(spark, [], schema)).collect() == []
    kept = toxicity.without_toxic(clashing(docs), frame(spark, [(1, None), (None, 1)], schema))
    assert kept.columns == clashing(docs).columns and kept.count() == len(ODD)


def test_features_see_insults_capitals_and_disguise():
    plain, rude = toxicity.features("the house is old", {}), toxicity.features("YOU are an IDIOT!! st*pid 1d1ot", {})
    assert rude[0] > plain[0] == 0 and rude[8] > 0 and rude[10] > plain[10] and rude[12] > 0
    assert toxicity.features("", {}) == [0.0] * toxicity.N_FEATURES == [0.0] * len(plain)


def test_pairs_of_ids_below_zero(spark):
    from branchyard.llm import queries

    rows = [(conv, turn, "assistant", f"{conv} {turn}") for conv in (-4, -3, -2, -1, 0, 1) for turn in (0, 1)]
    folder = f"{queries.work_folder(spark, 'negative')}"
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    got = {r.pair_id: (r.n_chosen_turns, r.n_rejected_turns) for r in queries.op5_preferences(spark, folder).collect()}
    assert got == {-2: (2, 2), -1: (2, 2), 0: (2, 2)}
    view = f"WITH conversations AS (SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')) SELECT * FROM ({queries.ORACLES['op5_preferences']})"
    assert sorted(duckdb.sql(view).fetchall()) == sorted(map(tuple, queries.op5_preferences(spark, folder).collect()))
