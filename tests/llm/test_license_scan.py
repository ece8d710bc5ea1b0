import re
import time

from cantolith.llm import license_scan as L


def brute(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, l) for p, l in L.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({l for _, l in places}))


def test_rules():
    s = L.Scanner()
    assert len(L.rules()) > 300
    for text, want in [
        ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("Released under the MIT License.", {"mit"}),
        ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
        ("SPDX-License-Identifier: BSD-3-Clause", {"bsd-3-clause"}),
        ("see https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa-4.0"}),
        ("under the terms of the GNU Lesser General Public License v2.1", {"lgpl-2.1"}),
        ("He was under the weather and had a licence to fish.", set()),
    ]:
        low = L.lower(text)
        assert {x[2] for x in s.detect(low)} == want, (text, s.detect(low))
        assert s.gate(low.encode()) or not want


def test_names_as_they_are_in_use():
    """What licenses are called in manifests, headers and sentences, by hand; each with the labels that must be among those found."""
    gated, every = L.Scanner(), L.Scanner(gated=False)
    for text, want in [
        ("licensed under MIT", {"mit"}), ("License: MIT", {"mit"}), ('"license": "MIT"', {"mit"}), ("license = 'MIT'", {"mit"}), ("MIT licensed", {"mit"}), ("Released under the MIT.", {"mit"}), ("License: Expat", {"expat"}), ("licenses: [ISC]", {"isc"}),
        ("GPLv3", {"gpl-3"}), ("GPLv2+", {"gpl-2"}), ("GPL v3", {"gpl-3"}), ("AGPLv3", {"agpl-3"}), ("LGPL v2.1", {"lgpl-2.1"}), ("GNU LGPL", {"lgpl"}), ("GNU GPL version 3", {"gpl-3"}), ("the GNU\n * GPL", {"gpl"}),
        ("dual licensed under MIT and Apache 2.0", {"mit", "apache-2.0"}), ("dual-licensed under Apache 2.0 or MIT", {"mit", "apache-2.0"}), ("CC0 1.0 Universal", {"cc0-1.0"}), ("Unlicense", {"unlicense"}), ("WTFPL", {"wtfpl"}), ("All rights reserved", {"all-rights-reserved"}),
        ("LGPL-2.1-or-later", {"lgpl-2.1"}), ("License: Apache-2.0", {"apache-2.0"}), ('license = "GPL-3.0-or-later"', {"gpl-3.0"}), ("license: cc-by-4.0", {"cc-by-4.0"}), ("CC-BY-NC-SA-4.0", {"cc-by-nc-sa-4.0"}), ("Eclipse Public License - v 2.0", {"epl-2.0"}), ("MPL-2.0, EPL-1.0", {"mpl-2.0", "epl-1.0"}),
    ]:
        low = L.lower(text)
        got = {x[2] for x in gated.detect(low)}
        assert want <= got and gated.detect(low) == every.detect(low), (text, got)
        assert gated.gate(low.encode()), text
    for text in ("vim is an editor under apache rule", "the mit and the bsd", "komm mit uns", "I submit under protest", "deploy a replica, please", "an x11 window", "he was permitted under law", "expatriates license cars", "gplates", "a-gpl", "the isc under review", "misc licensed goods"):
        low = L.lower(text)
        assert gated.detect(low) == every.detect(low) == [], (text, gated.detect(low))


def test_containment_and_priority():
    s = L.Scanner()
    found = s.detect("licensed under the gnu general public license, version 3")
    assert len(found) == 1 and found[0][:2] == (0, 56)
    two = s.detect("released under the mit license. " * 2)
    assert [x[2] for x in two] == ["mit", "mit"]


def test_query_base_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = dict(tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect())
    out = L.op1_license_scan(spark, d).collect()
    assert len(out) == len(docs)
    for r in out:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == (r.labels != "")
    assert sum(r.n_base for r in out) > 0


def test_edges(spark):
    texts = [None, "", "MIT\nLicense", "mit-license MIT license", "cc by cc by", "x" * 200000 + " apache license", "éMIT license", "gnu general public license" * 3, "ＭＩＴ license"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "mit license", "x"), (2, "MIT\nLicense", "x")], "doc_id long, text string, labels string")
    out = L.scan_licenses(docs).collect()
    assert len(out) == len(texts) + 2
    for r in out:
        if r.doc_id is not None:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
    assert L.scan_licenses(docs.limit(0)).count() == 0


def test_prefilter_drops_no_match_however_white_space_parts_the_words():
    gated, every = L.Scanner(), L.Scanner(gated=False)
    names = [re.sub(r"\[ -\]", "-", re.sub(r"\(\?:([^()|]*)\)\?", r"\1", n)).replace("licen[sc]e", "licence") for _, _, n, _, _ in L.FAMILIES]
    names += ["creative commons attribution non-commercial", "cc by sa"]
    tried = 0
    for name in names:
        for text in (f"released under the {name} 2.0", f"under {name.replace('licence', 'license')}, version 3"):
            for gap in (" ", "\n", "  ", "\t", "\r\n", "\u00a0", "\n * ", "\n# "):
                low = text.replace(" ", gap)
                want = every.detect(low)
                tried += bool(want)
                assert gated.detect(low) == want, (low, want)
                assert gated.gate(low.encode()) or not want, low
    assert tried > 500


def test_wrapped_headers(spark):
    texts = ["licensed under the GNU Lesser\nGeneral Public License v2.1", "GNU General\nPublic License, version 3 license", "released under the MIT\n  Licence"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.labels for r in L.scan_licenses(docs).collect()} == {0: "lgpl-2.1", 1: "gpl,gpl-3", 2: "mit"}


def every(low):
    """All rules without a gate, suppression by comparing every two detections."""
    found = []
    for k, r in enumerate(L.rules()):
        for m in r.pattern.finditer(low):
            version = next((g for g in m.groups() if g), None)
            found.append((r.priority, m.start(), m.end(), k, r.label + (f"-{version}" if version else ""), r.confidence))
    for line in re.finditer(r"spdx-licen[sc]e-identifier[ \t]?:[^\r\n]*", low):
        start, line = line.start(), line[0]
        for m in re.finditer(r"(?<![a-z0-9.+-])[a-z0-9][a-z0-9.+-]*", line[line.index(":") :]):
            if label := L.operand_label(m[0]):
                at = start + line.index(":") + m.start()
                found.append((100, at, at + len(m[0]), 0, label, 1.0))
    found.sort(key=lambda x: (-x[0], x[1] - x[2], x[1], x[3]))
    kept = []
    for x in found:
        if not any(y[1] <= x[1] and x[2] <= y[2] for y in kept):
            kept.append(x)
    return sorted((x[1], x[2], x[4], x[5]) for x in kept)


NOTICES = [
    "Permission is hereby granted, free of charge, to any person obtaining a copy\n// of this software and associated documentation files",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided. Neither the name of X nor the names of its contributors may be used to endorse or promote products derived from this software",
    "# Permission to use, copy, modify, and/or distribute this software for any\n# purpose with or without fee is hereby granted",
    "This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License",
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-or-later WITH Classpath-exception-2.0\nmore",
    "Apache License 2.0 and BSD 3-Clause; released into the public domain",
    "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages",
]


def test_texts_of_licenses():
    s = L.Scanner()
    got = [{x[2] for x in s.detect(L.lower(t))} for t in NOTICES]
    assert got == [{"mit"}, {"bsd", "bsd-3-clause"}, {"isc"}, {"gpl", "gpl-3"}, {"mit", "apache-2.0", "gpl-2.0"}, {"apache-2.0", "bsd-3-clause", "public-domain"}, {"zlib"}]


def test_query_equals_all_rules_without_a_gate(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10**6 + k, t) for k, t in enumerate([*NOTICES, " ".join(NOTICES), "\n".join(NOTICES * 3)])]
    out = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = every(L.lower(t or ""))
        assert [tuple(x) for x in out[i].spans] == want
        base = set(filter(None, brute(t)[4].split(",")))
        assert out[i].labels == ",".join(sorted(base | {x[2] for x in want}))
        assert out[i].score == max([0.7 * bool(base), *(x[3] for x in want)])


def test_many_mentions_take_no_square_of_time():
    s = L.Scanner()
    began = time.perf_counter()
    assert len(s.detect("licensed under the mit license. " * 20_000)) == 20_000
    assert time.perf_counter() - began < 5
