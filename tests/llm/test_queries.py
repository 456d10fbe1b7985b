"""Operators on Spark: brute force, held-out accuracy, and odd inputs."""

import hashlib
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskflow.llm import bucket_digest, byte_bpe, decontamination, edit_counts, language_id, license_scan, near_dedup, quality_ranking, secret_scan, warc_zip
from riskflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src/a", len(t or "")) for i, t in rows], DOCS)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "no id here at all"), (4, " \t\n "), (5, "x" * 70000),
       (6, "word " * 30000), (7, "é漢字 ünïcode"), (2, "")]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    known = sorted((tuple(r) for r in want.select(*cols).fetchall()), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert _rows(got.select(*cols)) == known


def test_byte_bpe_and_edits_on_odd_rows(spark):
    ranks, pattern = byte_bpe.default_tokenizer()
    enc = byte_bpe.encoding(ranks, pattern)
    got = {(r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in byte_bpe.tokenize(_docs(spark, ODD), ranks, pattern).collect()}
    assert got == {(i, len(enc.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD}
    edits = _docs(spark, ODD).withColumn("edits", F.expr(
        "case when doc_id = 3 then null else array(named_struct('start', 0, 'length', 2, 'replacement', 'zz'),"
        " named_struct('start', 999999, 'length', 5, 'replacement', cast(null as string))) end"))
    counted = edit_counts.count_edited(edits, ranks, pattern).collect()
    want = sorted(len(enc.encode_ordinary((t or "") if i == 3 else "zz" + (t or "")[2:])) for i, t in ODD)
    assert sorted(r["edited_tokens"] for r in counted) == want
    assert byte_bpe.tokenize(_docs(spark, []), ranks, pattern).count() == 0


def test_null_parts_of_edits_and_long_white_space(spark):
    ranks, pattern = byte_bpe.default_tokenizer()
    enc = byte_bpe.encoding(ranks, pattern)
    rows = [(1, "abc def", [None]), (2, "abc def", [(None, 3, "x")]), (3, "abc def", [(4, None, "x")]), (4, None, [(None, None, None)]),
            (5, " " * 1_000_000, [(10, 5, "word"), None]), (6, "\n" * 1_000_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:long,length:long,replacement:string>>")
    got = {r["doc_id"]: r for r in edit_counts.count_edited(docs, ranks, pattern).collect()}
    assert {i: (got[i]["n_edits"], got[i]["edited_chars"]) for i in got} == {
        1: (0, 7), 2: (1, 5), 3: (1, 8), 4: (1, 0), 5: (1, 999_999), 6: (0, 1_000_000)}
    assert got[2]["edited_tokens"] == len(enc.encode_ordinary("x def")) and got[3]["edited_tokens"] == len(enc.encode_ordinary("abc xdef"))
    done = {r["doc_id"]: r for r in byte_bpe.tokenize(docs.select("doc_id", "text"), ranks, pattern).collect()}
    assert done[5]["decoded_sha256"] == hashlib.sha256(b" " * 1_000_000).hexdigest() and done[5]["n_tokens"] == got[5]["n_tokens"]
    assert byte_bpe.token_ids(docs.drop("edits"), ranks, pattern).count() == 6


def test_fingerprints_follow_the_next_document(spark):
    rows = [(i * 7 % 101, f"text {i} " * (i % 9)) for i in range(101)] + [(None, "first of all"), (50, "twice"), (200, "")]
    got = bucket_digest.fingerprints(_docs(spark, rows).repartition(5)).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, t) in enumerate(order):
        edited = bucket_digest.edited_text(t, order[(k + 1) % len(order)][1]).encode()
        want.append((i, len(t), hashlib.sha256(edited).hexdigest(), bucket_digest.digest(t.encode()).hex()))
    key = str
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=key) == sorted(want, key=key)
    assert bucket_digest.fingerprints(_docs(spark, [])).count() == 0
    alone = bucket_digest.fingerprints(_docs(spark, [(1, "abcdef")])).collect()
    assert alone[0]["near_next"] == 1.0


def test_language_and_quality_on_held_out_rows(spark):
    lang = QUERIES["op8_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = lang.where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a")).first()["a"]
    assert held > 0.95
    quality = QUERIES["op3_quality_ranking"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    held = quality.where("held_out").select(F.avg((F.col("quality") == F.col("predicted")).cast("int")).alias("a")).first()["a"]
    assert held > 0.9


def test_language_and_quality_on_odd_rows(spark):
    docs = _docs(spark, ODD)
    model = language_id.train(docs, F.lit(False))
    assert {r["lang_pred"] for r in language_id.identify(docs, model).collect()} == {"und"}
    model = language_id.train(docs, F.lit(True))
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id.identify(docs, model).collect()}
    assert got == {(i, "en" if t and any(c.isalpha() for c in t) else "und") for i, t in ODD}
    assert language_id.keep_identified(docs, model).columns == docs.columns
    none = quality_ranking.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality_ranking.scored(docs, none).collect()} == {0.5}


def test_quality_of_odd_rows_with_a_trained_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = quality_ranking.train(docs, spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"))
    odd = spark.createDataFrame([(i, t, 0.25, "x") for i, t in [*ODD, (8, "y " * 400_000)]], "doc_id long, text string, score double, predicted string")
    got = quality_ranking.scored(odd.select("doc_id", "text"), model).collect()
    assert len(got) == len(ODD) + 1 and all(0.0 <= r["score"] <= 1.0 for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], set()).add(r["score"])
    assert by_id[1] == by_id[2] and all(len(v) == 1 for v in by_id.values())  # null as empty, equal rows alike
    assert quality_ranking.scored(odd.limit(0).select("doc_id", "text"), model).count() == 0
    nulls = spark.createDataFrame([(None, 1), (0, None), (0, 1), (1, 0)], "doc_id long, quality int")
    assert quality_ranking.scored(docs, quality_ranking.train(docs, nulls)).count() == docs.count()


def test_warc_of_odd_pages(spark):
    long = "x" * 100
    rows = [(5, None, long), (3, "http://a b/\r\n", long), (3, "u", long), (9, "u", "é" * 50), (1, "u", None), (2, "u", ""),
            (4, "u", "short"), (6, "u", "short"), (None, "u", long)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload_bytes int")
    got = {(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc_zip.archive_round_trip(pages).collect()}
    assert got == {(5, 100, "revisit", 3), (3, 100, "response", None), (9, 100, "response", None), (1, 0, "response", None),
                   (2, 0, "response", None), (4, 5, "response", None), (6, 5, "response", None), (None, 100, "revisit", 3)}
    assert warc_zip.archive_round_trip(pages.limit(0)).count() == 0


def test_packages_roll_and_blocks_split(spark):
    pages = spark.createDataFrame([(i, f"u{i}", os.urandom(300).hex()) for i in range(200)], "page_id long, url string, html string")
    from riskflow.session import scratch_path

    folder = scratch_path(spark, "warc-test")
    packages = warc_zip.write_packages(warc_zip.classify(pages), folder, package_bytes=5000)
    assert packages.count() > 10 and packages.agg(F.sum("records")).first()[0] == 200
    back = warc_zip.read_records(warc_zip.locate_records(packages, folder, block_bytes=1000), folder, with_payload=True)
    assert {(r["page_id"], r["payload"].decode()) for r in back.collect()} == {(r["page_id"], r["html"]) for r in pages.collect()}


def _near_brute(rows, words, percent):
    def grams(t):
        w = [x for x in (t or "").encode().lower().split()]
        return {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()

    sets = [(i, grams(t)) for i, t in rows]
    comp = {i: i for i, _ in sets}
    changed = True
    while changed:
        changed = False
        for i, a in sets:
            for j, b in sets:
                if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b) and comp[i] != comp[j]:
                    comp[i] = comp[j] = min(comp[i], comp[j])
                    changed = True
    return sets, comp


def test_near_duplicates_equal_brute_force(spark):
    import random

    rng = random.Random(2)
    rows, n = [], 0
    for _ in range(4):
        base = [f"w{rng.randrange(4000)}" for _ in range(150)]
        for _ in range(30):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
            rows.append((n, " ".join(w)))
            n += 1
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(n + i, passage + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(5, 60)))) for i in range(30)]
    rows += [(500, rows[7][1].upper()), (500, rows[7][1].upper()), (501, "one two"), (502, "ONE  two"), (503, None), (504, "")]
    got = near_dedup.near_duplicates(_docs(spark, rows).repartition(4), words=4, percent=80).collect()
    sets, comp = _near_brute(rows, 4, 80)
    want = sorted((i, len(s), comp[i], comp[i] == i) for i, s in sets)
    assert sorted((r[0], r[1], r[2], r[3]) for r in got) == want


def test_near_duplicates_of_odd_rows(spark):
    got = {(r[0], r[1], r[2], r[3]) for r in near_dedup.near_duplicates(_docs(spark, ODD)).collect()}
    assert {g for g in got if g[0] in (1, 2, 4)} == {(1, 0, 1, True), (2, 0, 2, True), (4, 0, 4, True)}
    assert (None, 1, None, True) in got
    assert near_dedup.near_duplicates(_docs(spark, [])).count() == 0
    kept = near_dedup.keep_one(_docs(spark, ODD).withColumn("kept", F.lit(1)))
    assert kept.columns[-1] == "kept" and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "6", "7", "None"]


def test_one_of_each_group_stays_though_ids_repeat(spark):
    rng = random.Random(6)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(200)) for _ in range(4))
    near = a.rsplit(" ", 3)[0] + " another few words"
    # 5 holds two clean texts; 7 a near copy of 5's and a clean text; 9 one text twice; 3 and 8 are null and empty.
    rows = [(5, a), (5, b), (7, near), (7, c), (9, d), (9, d), (3, None), (3, "alone"), (8, ""), (None, a)]
    for parts in (1, 4):
        got = near_dedup.keep_one(_docs(spark, rows).repartition(parts))
        assert _rows(got.select("doc_id", "text")) == _rows(_docs(
            spark, [(5, a), (5, b), (7, c), (9, d), (3, None), (3, "alone"), (8, ""), (None, a)]).select("doc_id", "text"))


def test_license_scan_of_odd_rows(spark):
    rows = ODD + [(20, "Under THE mit license under the mit license"), (21, "cc by-nc; apache license, version 2.0"),
                  (22, "line one\nRedistribution and use in source and binary forms, with or without modification, are permitted "
                       "provided that the following conditions are met:"), (23, "mit license under the")]
    got = {r["doc_id"]: r.asDict() for r in license_scan.scan(_docs(spark, rows)).collect()}
    assert (got[20]["n_base"], got[20]["first_word"], got[20]["last_word"], got[20]["labels"]) == (2, 0, 4, "mit")
    assert got[21]["base_labels"] == "apache-2,cc-by-nc"
    assert got[22]["base_labels"] == "" and got[22]["labels"] == "bsd" and got[22]["score"] == 1.0
    assert got[23]["labels"] == "" and got[1]["n_words"] == 0 and got[1]["first_word"] is None
    assert license_scan.scan(_docs(spark, [])).count() == 0


MIT_GRANT = """/*
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 */"""
GPL_GRANT = """# This program is free software: you can redistribute it and/or modify it
# under the terms of the GNU General Public License as published by the Free
# Software Foundation, either version {} of the License, or (at your option)
# any later version."""
BSD_CLAUSE = """// Redistribution and use in source and binary forms, with or without
// modification, are permitted provided that the following conditions are met:"""
APACHE_LAW = """ * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""


def _met_brute(text, templates, containment=license_scan.CONTAINMENT):
    words, met = license_scan.words_of(text), set()
    for t, (_, template) in enumerate(templates):
        size, known = license_scan.block_words(template), set(license_scan.words_of(template))
        for at in range(len(words)):
            common = len(known & set(words[at:at + size]))
            if common >= containment * len(known) - 1e-9:
                met.add((t, at, common / len(known)))
    return met


def test_wrapped_notices_and_very_long_lines(spark):
    mit = license_scan.words_of(license_scan.TEMPLATES[1][1])
    scattered = " ".join(f"{w} " + "filler " * 300 for w in mit)
    rows = [(1, MIT_GRANT), (2, GPL_GRANT.format(3)), (3, BSD_CLAUSE), (4, APACHE_LAW), (5, scattered),
            (6, scattered + MIT_GRANT.replace("\n", " ") + " filler" * 5000)]
    got = {r["doc_id"]: r["labels"].split(",") for r in license_scan.scan(_docs(spark, rows)).collect()}
    assert (got[1], got[3], got[4], got[5], got[6]) == (["mit"], ["bsd"], ["apache-2"], [""], ["mit"])
    assert "gpl-3" in got[2]


def test_siblings_get_only_their_own_label(spark):
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    lesser = GPL_GRANT.replace("GNU General", "GNU Lesser General")
    notices = [(cc.format(""), "cc-by"), (cc.format("-NonCommercial"), "cc-by-nc"), (cc.format("-ShareAlike"), ""),
               (cc.format("-NonCommercial-ShareAlike"), ""), (GPL_GRANT.format(2), "gpl-2"), (GPL_GRANT.format(3), "gpl-3"),
               (lesser.format(3), "lgpl"), (lesser.format("2.1"), "lgpl"), (GPL_GRANT.replace("GNU", "GNU Affero").format(3), ""),
               (GPL_GRANT.format(2) + "\n" + lesser.format(3), "gpl-2,lgpl"), (MIT_GRANT, "mit"), (BSD_CLAUSE, "bsd"),
               (APACHE_LAW, "apache-2")]
    notices += [(text, label) for label, text in license_scan.TEMPLATES]
    rows = [(i, text) for i, (text, _) in enumerate(notices)]
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan(_docs(spark, rows)).collect()}
    assert [(notices[i], got[i]) for i in got if got[i] != notices[i][1]] == []


SHORT = [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("Licensed under the GNU General Public License v2 or later", "gpl-2"),
    ("released under version 2 of the GNU General Public License", "gpl-2"),
    ("This is free software under the GNU GPL, version 3.", "gpl-3"), ("This code is under the GPLv2.", "gpl-2"),
    ("licensed under the GNU Lesser General\nPublic License, version 2.1", "lgpl"), ("under the LGPL", "lgpl"),
    ("licensed under the Mozilla Public License 2.0", "mpl-2"), ("Mozilla Public License, version 2.0", "mpl-2"),
    ("Use is governed by the 3-clause BSD license.", "bsd"), ("available under the BSD license", "bsd"),
    ("Dedicated to the public under CC0 1.0 Universal", "cc0"), ("Creative Commons Zero", "cc0"),
    ("MIT License\n\nCopyright (c) 2020 Somebody", "mit"), ("the Apache License 2.0", "apache-2"),
    ("Text under CC BY 4.0", "cc-by"), ("Creative Commons Attribution 4.0", "cc-by"),
    ("Creative Commons Attribution-NonCommercial 4.0", "cc-by-nc"),
    ("// SPDX-License-Identifier: GPL-2.0-only", "gpl-2"), ("# SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl"),
    ("SPDX-License-Identifier: MIT", "mit"), ("SPDX-License-Identifier: Apache-2.0", "apache-2"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd"), ("SPDX-License-Identifier: MPL-2.0", "mpl-2"),
    ("GNU Affero General Public License, version 3", ""), ("Creative Commons Attribution-ShareAlike 4.0", ""),
    ("the general public may read version 3 of this GNU page", ""), ("the MIT campus", "")]


def test_short_notices_without_base_places(spark):
    found = license_scan.scan(_docs(spark, [(i, text) for i, (text, _) in enumerate(SHORT)])).collect()
    assert all(r["n_base"] == 0 for r in found)
    assert [(SHORT[r["doc_id"]], r["labels"]) for r in found if r["labels"] != SHORT[r["doc_id"]][1]] == []
    rows = license_scan.scan(spark.read.parquet(f"{os.path.dirname(SF)}/sf0.01/documents.parquet")).where("labels like '%gpl-3%'")
    assert {(r["n_base"], r["labels"]) for r in rows.collect()} == {(0, "gpl-3")}


TOLD = [
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache-2,mit"), ("SPDX-License-Identifier: (GPL-2.0-only OR MIT)", "gpl-2,mit"),
    ("SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception", "apache-2"), ("SPDX-License-Identifier: BSD-3-Clause AND MIT", "bsd,mit"),
    (GPL_GRANT.format(3) + "\nEclipse Public License version 2", "gpl-3"), ("Licensed under GPL-3.0", "gpl-3"), ("License: MIT", "mit"),
    ("licensed under Apache 2.0", "apache-2"), ("License: CC-BY-4.0", "cc-by"), ("licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("SPDX-License-Identifier: GPL-2.0-only\n# Copyright MIT 2020", "gpl-2"), ("GNU General Public License. Eclipse Public License, version 2", "")]


def test_expressions_and_neighbouring_licenses(spark):
    found = license_scan.scan(_docs(spark, [(i, text) for i, (text, _) in enumerate(TOLD)])).collect()
    assert [(TOLD[r["doc_id"]], r["labels"]) for r in found if r["labels"] != TOLD[r["doc_id"]][1]] == []


def test_repetitive_texts_of_many_megabytes(spark):
    unit = "under the gplv2 "
    rows = [(1, unit * (4_000_000 // len(unit))), (2, "x" * 20_000_000), (3, "under the mit license " * 100_000), (4, " " * 3_000_000 + "cc by nc")]
    got = {r["doc_id"]: r for r in license_scan.scan(_docs(spark, rows)).collect()}
    assert (got[1]["labels"], got[1]["n_words"]) == ("gpl-2", 3 * (4_000_000 // len(unit)))
    assert (got[2]["labels"], got[2]["n_words"]) == ("", 1)
    assert (got[3]["labels"], got[3]["n_base"], got[3]["last_word"]) == ("mit", 100_000, 4 * 99_999)
    assert (got[4]["labels"], got[4]["first_word"]) == ("cc-by-nc", 0)


@pytest.mark.parametrize("piece", [16, 512])
def test_blocks_over_the_ends_of_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(license_scan, "SHORT_CHARS", 0)
    monkeypatch.setattr(license_scan, "PIECE_WORDS", piece)
    monkeypatch.setattr(license_scan, "_PIECE", license_scan._PIECE.replace("512", str(piece)))
    rng = random.Random(3)
    templates = [("a", "one two three four five six seven eight nine"), ("b", "one [two three]"), ("c", "[four] ... six")]
    pool = "one two three four five six seven eight nine x, y-z é".split()
    rows = [(i, "-- " * (i % 2) + rng.choice([" ", "\n", "; "]).join(rng.choice(pool) for _ in range(rng.randrange(10, 90))) + "!" * (i % 3)) for i in range(40)]
    if piece == 512:
        rows = [(i, " ".join(t for _, t in rows[i:] + rows[:i])) for i in range(3)]
    found = license_scan.similar_blocks(_docs(spark, rows).select("doc_id", "text"), templates).collect()
    want = set()
    for i, text in rows:
        words = license_scan.words_of(text)
        for t, at, score in _met_brute(text, templates):
            block = " " + " ".join(words[at:at + license_scan.block_words(templates[t][1])]) + " "
            if all(f" {p} " in block for p in license_scan.required_phrases(templates[t][1])):
                want.add((i, t, at, score))
    assert {(r["doc_id"], r["template"], r["at"], r["score"]) for r in found} == want and want


def test_blocks_equal_brute_force(spark):
    rng = random.Random(11)
    templates = [("a", "one two three four five six seven eight nine ten eleven"), ("b", "one two two three"),
                 ("c", "red green blue one"), ("d", "single")]
    pool = "one two three four five six seven eight nine ten eleven red green blue single x y z".split()
    rows = [(i, " ".join(rng.choice(pool[:rng.randrange(1, 19)]) for _ in range(rng.randrange(60)))) for i in range(80)]
    rows += [(100 + i, "x " * i + templates[0][1].replace(" ", "\n", i) + " z" * (5 - i)) for i in range(6)]
    found = license_scan.similar_blocks(_docs(spark, rows).select("doc_id", "text"), templates).collect()
    got = {(r["doc_id"], r["template"], r["at"], r["score"]) for r in found}
    assert got == {(i, *m) for i, text in rows for m in _met_brute(text, templates)}


def test_secrets_found_and_replaced(spark):
    key = "0a9f8e7d6c5b4a39281706f5e4d3c2b1a0ffeedd"
    rows = [(i, f'some words here token = "{i:04d}{key[4:]}" and more') for i in range(300, 340)]
    rows += [(100 + i, f"card 49929{i:011d} and a veryveryverylongwordwithoutdigits") for i in range(40)] + ODD
    docs = _docs(spark, rows)
    found = secret_scan.findings(docs)
    flagged = {r["doc_id"] for r in found.where("is_secret").collect()}
    assert flagged == set(range(300, 340))
    for r in found.where("doc_id is not null").collect():
        text = dict(rows)[r["doc_id"]]
        assert text[r["start"]:r["start"] + len(r["cand"])] == r["cand"]
    clean = {(r["doc_id"], r["text"]) for r in secret_scan.redact(docs).collect()}
    assert clean == {(i, 'some words here token = "[SECRET]" and more' if "token" in (t or "") else t) for i, t in rows}
    assert secret_scan.findings(_docs(spark, [])).count() == 0


NAMES = ["AWS_SECRET_ACCESS_KEY={}", 'aws_secret_access_key = "{}"', "DATABASE_PASSWORD_PRODUCTION: {}", '"client_secret_production": "{}",',
         "export GITHUB_ACCESS_TOKEN='{}'", "STRIPE_SECRET_KEY={}", "# note: aws_secret_access_key = '{}'"]


def test_secrets_behind_long_names(spark):
    rng = random.Random(4)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rows = {}
    for i in range(60):  # every third value has no digits
        value = "".join(rng.choice(chars + "0123456789" * (i % 3 > 0)) for _ in range(32))
        rows[i] = ("some prose\n" + NAMES[i % 7].format(value) + "\nmore prose", value)
    for i in range(60):
        digest = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        rows[100 + i] = (f"release_checksum_value = {digest} and a veryveryverylongwordwithoutdigits", None)
    rows[200] = ("MY_API_SECRET_VALUE=" + "Zk4" * 9 + "\nRELEASE_CHECKSUM_VALUE=" + "0a9f8e7d6c5b4a39" * 2, "Zk4" * 9)
    docs = _docs(spark, [(i, text) for i, (text, _) in rows.items()])
    near = secret_scan.candidates(docs).collect()
    for r in near:
        text, end = rows[r["doc_id"]][0], r["start"] + len(r["cand"])
        assert r["before"] == text[max(r["start"] - secret_scan.NEAR_CHARS, 0):r["start"]]
        assert r["after"] == text[end:end + secret_scan.AFTER_CHARS]
    got = {}
    for r in secret_scan.findings(docs).where("is_secret").collect():
        got.setdefault(r["doc_id"], []).append(r["cand"])
    assert got == {i: [value] for i, (_, value) in rows.items() if value}


def _planted_findings(rng, n):
    """Documents with one finding each: (id, text, source, start, label)."""
    letters, out = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", []
    prose = "the report of the committee was read and the members agreed to meet again in the spring".split()
    secret = ["db_password = '{}'", "API_TOKEN={}", "client_secret: {}", "postgres://admin:{}@db.internal:5432/app", "passphrase = \"{}\"",
              "the service credential is {} as agreed", "x-session-signature: {}"]
    harmless = ["commit {} by the author", "sha256 = {}", "trace_identifier={}", "etag: {}", "build {} finished", "cache_key = '{}'",
                "see node {} of the graph"]
    for i in range(n):
        label = int(rng.random() < 0.5)
        if label:
            value = "".join(rng.choice(letters) for _ in range(rng.randint(18, 40)))
        else:
            value = "".join(rng.choice(rng.choice(["0123456789abcdef", "0123456789"])) for _ in range(rng.randint(18, 40)))
            if rng.random() < 0.3:
                value = "-".join(rng.sample(prose, 4))
        form = rng.choice(secret if label else harmless)
        head = " ".join(rng.choices(prose, k=rng.randint(3, 30))) + "\n" + form[:form.index("{}")]
        tail = form[form.index("{}") + 2:] + "\n" + " ".join(rng.choices(prose, k=8))
        out.append((i, head + value + tail, rng.choice(["src/app/config.py", "docs/guide.md", "tests/data.txt"]), len(head), label))
    return out


def test_labelled_findings_teach_the_forest(spark):
    rows = _planted_findings(random.Random(12), 1200)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
    known = spark.createDataFrame([(r[0], r[3], r[4]) for r in rows if r[0] % 2 == 0], "doc_id long, start int, label int")
    found = {(r["doc_id"], r["start"]): r["is_secret"] for r in secret_scan.findings(docs, labelled=known).collect()}
    held = [(found[r[0], r[3]], r[4]) for r in rows if r[0] % 2 and (r[0], r[3]) in found]
    assert len(held) > 0.97 * len(rows) / 2  # nearly every planted string is a candidate
    hits = sum(1 for got, label in held if got and label)
    assert hits / sum(1 for got, _ in held if got) >= 0.9
    assert hits / sum(r[4] for r in rows if r[0] % 2) >= 0.9  # strings that are no candidates count as missed


def test_the_rule_and_the_forest_share_no_column():
    assert not set(secret_scan.FEATURES) & set(secret_scan.CONTEXT)
    names = str(secret_scan.label_by_rule.__code__.co_consts) + str(secret_scan.CONTEXT)
    assert not any(f"'{f}'" in names for f in secret_scan.FEATURES)


def test_passwords_in_urls_and_tokens_of_parts(spark):
    rng = random.Random(9)
    word = lambda k: "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(k))
    rows = {}
    for i in range(60):
        password, token = word(12), f"eyJ{word(20)}.eyJ{word(30)}.{word(43)}"
        rows[i] = ((f"DATABASE=postgres://admin:{password}@db.host:5432/app?x=1", password) if i % 2 else
                   (f"Authorization: Bearer {token}", token))
        rows[100 + i] = (f"see https://example{i}.org:8080/some/path and checksum {word(16).lower()}00", None)
    found = secret_scan.findings(_docs(spark, [(i, text) for i, (text, _) in rows.items()])).where("is_secret").collect()
    got = {}
    for r in found:
        got.setdefault(r["doc_id"], []).append(r["cand"])
    assert got == {i: [value] for i, (_, value) in rows.items() if value}
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(_docs(spark, [(i, text) for i, (text, _) in rows.items()])).collect()}
    assert clean[0] == "Authorization: Bearer [SECRET]" and clean[1] == "DATABASE=postgres://admin:[SECRET]@db.host:5432/app?x=1"


def test_decontamination_stage(spark):
    item = "A benchmark question that is long enough to be found in any text that holds it word by word"
    bench = spark.createDataFrame([(1, item), (2, None), (1, item)], "item_id long, text string")
    docs = _docs(spark, [*ODD, (50, "before it. " + item.upper() + " after it."), (51, item[:30])])
    assert {r["doc_id"] for r in decontamination.leaks(docs, bench).collect()} == {50}
    assert decontamination.drop_leaks(docs, bench).count() == len(ODD) + 1
    assert decontamination.leaks(docs, bench, block_segments=1).count() == 2 * decontamination.leaks(
        docs, bench.limit(1)).count()
    assert decontamination.leaks(docs, bench.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("Extra", F.lit(1)).withColumn("score", F.lit("s"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        docs = stage(spark, docs, SF)
        assert docs.columns == before, name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "Extra", "score", "n_tokens", "token_ids"]
    ids = [r["doc_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) and 0 < len(ids) < 200
    assert corpus_pipeline.run(spark, SF).count() == len(ids)
