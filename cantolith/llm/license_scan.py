"""License scans: ordered signature rules behind a keyword prefilter.

There are hand-written signatures of license texts and notices (BODIES), short forms that are in use
(short_forms), and rules made from FAMILIES and TEMPLATES for names, versions and web addresses: some hundreds of regexes, each with
words that any match holds, a priority and a confidence. A text is searched with the rules whose
words it holds. The operands of SPDX expressions are looked up one by one. A detection that lies
inside one of higher or equal priority is suppressed; detections that merely overlap stay. Base
phrases are found as words in a row and are never suppressed.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .common import in_batches, pieces, table, utf8

# The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Fixed values: (label, keyword, name, SPDX identifiers, place on the web); a version in a name's group goes to the label.
FAMILIES = (
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", r"agpl-\d[.\d]*(?:-only|-or-later|\+)?", r"gnu\.org/licenses/agpl"),
    ("agpl", "agpl", r"(?:gnu )?agpl", r"agpl", r"gnu\.org/licenses/agpl"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public licen[sc]e", r"lgpl-\d[.\d]*(?:-only|-or-later|\+)?", r"gnu\.org/licenses/lgpl"),
    ("lgpl", "library general", r"(?:gnu )?library general public licen[sc]e", r"lgpl-2\.0", r"gnu\.org/licenses/old-licenses/lgpl"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", r"lgpl", r"gnu\.org/copyleft/lesser"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e", r"gpl-\d[.\d]*(?:-only|-or-later|\+)?", r"gnu\.org/licenses/gpl"),
    ("gpl", "gpl", r"(?:gnu )?gpl", r"gpl", r"gnu\.org/copyleft/gpl"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", r"gfdl-\d[.\d]*", r"gnu\.org/licenses/fdl"),
    ("apache", "apache licen", r"apache(?: software)? licen[sc]e", r"apache-\d[.\d]*", r"apache\.org/licenses/license"),
    ("apache", "apache", r"apache(?: software)?", r"apache", r"apache\.org/licenses"),
    ("mit", "mit licen", r"mit licen[sc]e", r"mit", r"opensource\.org/licenses?/mit"),
    ("expat", "expat", r"expat licen[sc]e", r"expat", r"directory\.fsf\.org/wiki/license:expat"),
    ("bsd", "bsd", r"(?:\d-clause |new |modified |simplified |original )?bsd(?:[ -]\d[ -]clause)?", r"bsd-\d-clause", r"opensource\.org/licenses?/bsd"),
    ("0bsd", "zero-clause", r"zero-clause bsd", r"0bsd", r"opensource\.org/licenses?/0bsd"),
    ("isc", "isc licen", r"isc licen[sc]e", r"isc", r"opensource\.org/licenses?/isc"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", r"mpl-\d[.\d]*", r"mozilla\.org/(?:en-us/)?mpl"),
    ("mpl", "mpl", r"mpl", r"mpl", r"mozilla\.org/mpl"),
    ("epl", "eclipse", r"eclipse public licen[sc]e", r"epl-\d[.\d]*", r"eclipse\.org/legal/epl"),
    ("edl", "eclipse dist", r"eclipse distribution licen[sc]e", r"edl-\d[.\d]*", r"eclipse\.org/org/documents/edl"),
    ("cddl", "common development", r"common development and distribution licen[sc]e", r"cddl-\d[.\d]*", r"opensource\.org/licenses?/cddl"),
    ("cpl", "common public", r"common public licen[sc]e", r"cpl-\d[.\d]*", r"opensource\.org/licenses?/cpl"),
    ("ipl", "ibm public", r"ibm public licen[sc]e", r"ipl-\d[.\d]*", r"opensource\.org/licenses?/ipl"),
    ("eupl", "european union public", r"european union public licen[sc]e", r"eupl-\d[.\d]*", r"joinup\.ec\.europa\.eu/.{0,40}eupl"),
    ("eupl", "eupl", r"eupl", r"eupl", r"eupl\.eu"),
    ("artistic", "artistic", r"artistic licen[sc]e", r"artistic-\d[.\d]*", r"opensource\.org/licenses?/artistic"),
    ("bsl", "boost software", r"boost software licen[sc]e", r"bsl-\d[.\d]*", r"boost\.org/license"),
    ("busl", "business source", r"business source licen[sc]e", r"busl-\d[.\d]*", r"mariadb\.com/bsl"),
    ("sspl", "server side public", r"server side public licen[sc]e", r"sspl-\d[.\d]*", r"mongodb\.com/licensing/server-side"),
    ("elastic", "elastic licen", r"elastic licen[sc]e", r"elastic-\d[.\d]*", r"elastic\.co/licensing"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e", r"zlib", r"zlib\.net/zlib_license"),
    ("libpng", "libpng", r"libpng licen[sc]e", r"libpng(?:-2\.0)?", r"libpng\.org/pub/png/src/libpng-license"),
    ("psf", "python software", r"python software foundation licen[sc]e", r"psf-\d[.\d]*|python-\d[.\d]*", r"docs\.python\.org/\d/license"),
    ("php", "php licen", r"php licen[sc]e", r"php-\d[.\d]*", r"php\.net/license"),
    ("ruby", "ruby licen", r"ruby licen[sc]e", r"ruby", r"ruby-lang\.org/en/about/license"),
    ("perl", "same terms as perl", r"same terms as perl(?: itself)?", r"artistic-1\.0-perl", r"dev\.perl\.org/licenses"),
    ("openssl", "openssl", r"openssl licen[sc]e", r"openssl", r"openssl\.org/source/license"),
    ("openldap", "openldap", r"openldap public licen[sc]e", r"oldap-\d[.\d]*", r"openldap\.org/software/release/license"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", r"postgresql", r"postgresql\.org/about/licen[sc]e"),
    ("w3c", "w3c", r"w3c (?:software|document)(?: notice and)? licen[sc]e", r"w3c", r"w3\.org/consortium/legal"),
    ("unicode", "unicode", r"unicode(?:, inc\.)? licen[sc]e", r"unicode-(?:dfs-\d{4}|tou|3\.0)", r"unicode\.org/(?:copyright|license)"),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e", r"ofl-\d[.\d]*", r"scripts\.sil\.org/ofl"),
    ("odbl", "open database", r"open database licen[sc]e", r"odbl-\d[.\d]*", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by", "open data commons", r"open data commons attribution licen[sc]e", r"odc-by-\d[.\d]*", r"opendatacommons\.org/licenses/by"),
    ("pddl", "public domain dedication", r"public domain dedication and licen[sc]e", r"pddl-\d[.\d]*", r"opendatacommons\.org/licenses/pddl"),
    ("cc0", "cc0", r"(?:creative commons )?cc0", r"cc0-\d[.\d]*", r"creativecommons\.org/publicdomain/zero"),
    ("cc0", "creative commons", r"creative commons zero", r"cc0-\d[.\d]*", r"creativecommons\.org/publicdomain/zero"),
    ("unlicense", "unlicense", r"unlicense", r"unlicense", r"unlicense\.org"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl", r"wtfpl\.net"),
    ("ms-pl", "microsoft public", r"microsoft public licen[sc]e", r"ms-pl", r"opensource\.org/licenses?/ms-pl"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[sc]e", r"ms-rl", r"opensource\.org/licenses?/ms-rl"),
    ("osl", "open software licen", r"open software licen[sc]e", r"osl-\d[.\d]*", r"opensource\.org/licenses?/osl"),
    ("afl", "academic free", r"academic free licen[sc]e", r"afl-\d[.\d]*", r"opensource\.org/licenses?/afl"),
    ("upl", "universal permissive", r"universal permissive licen[sc]e", r"upl-\d[.\d]*", r"oss\.oracle\.com/licenses/upl"),
    ("cecill", "cecill", r"cecill(?:-[bc])?", r"cecill-\d[.\d]*", r"cecill\.info"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa open source licen[sc]e", r"ncsa", r"opensource\.org/licenses?/ncsa"),
    ("rail", "responsible ai", r"responsible ai licen[sc]e", r"openrail(?:\+\+)?(?:-m)?", r"licenses\.ai"),
    ("qpl", "q public", r"q public licen[sc]e", r"qpl-\d[.\d]*", r"opensource\.org/licenses?/qtpl"),
    ("vim", "vim licen", r"vim licen[sc]e", r"vim", r"vimdoc\.sourceforge\.net/.{0,40}licen"),
    ("x11", "x11 licen", r"x11 licen[sc]e", r"x11", r"xfree86\.org/.{0,20}licen"),
)
# Creative Commons variants, from the longest on.
COMMONS = (("cc-by-nc-sa", "nc", "sa"), ("cc-by-nc-nd", "nc", "nd"), ("cc-by-nc", "nc"), ("cc-by-nd", "nd"), ("cc-by-sa", "sa"), ("cc-by",))
LONG = {"nc": r"non-?commercial", "sa": r"share-?alike", "nd": r"no-?deriv(?:ative)?s?"}
VERSION = r"(?:[\s,(]{1,3}(?:version |v\.? ?|ver\. ?)?(\d(?:\.\d)?)(?![\d.]?\d)|v(\d(?:\.\d)?))?"
#: (template, priority, confidence) of a name; the first that contains others wins over them.
TEMPLATES = (
    (r"\b(?:licen[sc]ed|released|distributed|published|available|provided|redistributed|offered|shared)(?: to you)? under(?: the)?(?: terms of)?(?: the)? {name}\b{version}(?: licen[sc]e\b)?", 90, 0.95),
    (r"\b(?:subject to|governed by|covered by|under)(?: the)?(?: terms (?:and conditions )?of)?(?: the)? {name}\b{version}(?: licen[sc]e\b)?", 70, 0.8),
    (r"\blicen[sc]e ?[:=] ?\"?{name}\b{version}", 80, 0.9),
    (r"\b{name}\b{version},? licen[sc]e\b", 60, 0.7),
)
#: A whole name with its version: (template, priority, confidence), for names that say license themselves.
BARE = (r"\b{name}\b{version}", 65, 0.7)
#: The head of an SPDX expression, which ends with its line; an operand; what is no operand, and the word before an exception.
SPDX, OPERAND, JOINS, EXCEPT = re.compile(r"\bspdx-licen[sc]e-identifier[ \t]?:[ \t]*([^\r\n]{1,1000})"), re.compile(r"[a-z0-9][a-z0-9.+-]*"), frozenset(["and", "or"]), "with"
SPDX_PRIORITY = 100
WEB = (r"\b(?:https?://)?(?:www\.)?{web}", 50, 0.85)


# Fixed values: (label, phrase, priority, confidence) of license texts and notices. Between words any white space and signs
# of comments may stand; "..." is anything of up to 200 characters, "#" a version, "a|b" either word.
BODIES = (
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation", 97, 0.97),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 80, 0.85),
    ("mit-0", "permission is hereby granted, free of charge ... to deal in the software without restriction ... so. the software is provided", 96, 0.8),
    ("bsl", "permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation", 97, 0.97),
    ("unicode", "permission is hereby granted, free of charge, to any person obtaining a copy of the unicode|data data|files", 97, 0.95),
    ("permissive", "permission is hereby granted, free of charge", 60, 0.7),
    ("ncsa", "to deal with the software without restriction", 80, 0.85),
    ("bsd", "redistribution and use in source and binary forms, with or without modification, are permitted", 90, 0.95),
    ("bsd", "redistribution and use in source and binary forms", 60, 0.8),
    ("bsd-3-clause", "neither the name|names of ... may be used to endorse or promote products derived from this software", 95, 0.95),
    ("bsd-3-clause", "the name of the author|authors may not be used to endorse or promote products", 94, 0.9),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledgement|acknowledgment", 96, 0.95),
    ("bsd-2-clause", "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer", 70, 0.7),
    ("isc", "permission to use, copy, modify, and|and/or distribute this software for any purpose with or without fee is hereby granted", 97, 0.97),
    ("hpnd", "permission to use, copy, modify, and|distribute distribute|and ... this software and its documentation for any purpose ... is hereby granted", 85, 0.85),
    ("0bsd", "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. the software is provided", 98, 0.95),
    ("w3c", "permission to copy, modify, and distribute this software and its documentation, with or without modification, for any purpose and without fee or royalty", 95, 0.95),
    ("apache-2.0", "licensed under the apache license, version 2.0 (the license)", 96, 0.98),
    ("apache-2.0", "you may not use this file except in compliance with the license. you may obtain a copy of the license at ... apache.org/licenses/license-2.0", 97, 0.98),
    ("apache", "unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis", 60, 0.8),
    ("gpl", "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation ... version #", 97, 0.98),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the gnu lesser|library general public license as published by the free software foundation ... version #", 97, 0.98),
    ("agpl", "you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation ... version #", 97, 0.98),
    ("copyleft", "you can redistribute it and/or modify it", 40, 0.6),
    ("gpl", "you should have received a copy of the gnu general public license along with this program", 88, 0.9),
    ("lgpl", "you should have received a copy of the gnu lesser|library general public license along with this|the library|program|software", 88, 0.9),
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program", 88, 0.9),
    ("gpl", "this program is distributed in the hope that it will be useful, but without any warranty", 50, 0.7),
    ("gpl", "this program is free software ... you can redistribute it", 45, 0.7),
    ("gfdl", "permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license, version #", 97, 0.98),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license, v. 2.0", 97, 0.98),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1.1", 97, 0.98),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license v|version #", 96, 0.97),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", 96, 0.97),
    ("zlib", "this software is provided as-is, without any express or implied warranty. in no event will the author|authors be held liable for any damages", 96, 0.95),
    ("zlib", "the origin of this software must not be misrepresented", 80, 0.85),
    ("libpng", "the contributing authors disclaim all warranties, expressed or implied", 80, 0.8),
    ("unlicense", "this is free and unencumbered software released into the public domain", 97, 0.98),
    ("public-domain", "released|placed|dedicated|put into|in|to the public domain", 60, 0.8),
    ("public-domain", "this work|file|code|software|program is in the public domain", 60, 0.8),
    ("cc0", "to the extent possible under law ... waived all copyright and related or neighboring|neighbouring rights", 96, 0.97),
    ("wtfpl", "do what the fuck you want to public license", 95, 0.95),
    ("beerware", "as long as you retain this notice you can do whatever you want with this stuff", 95, 0.95),
    ("json", "the software shall be used for good, not evil", 95, 0.95),
    ("openssl", "this product includes software developed by the openssl project", 90, 0.9),
    ("psf", "psf is making python # available to licensee", 90, 0.9),
    ("psf", "psf is making python available to licensee on an as is basis", 90, 0.9),
    ("ofl", "this font software is licensed under the sil open font license, version #", 97, 0.98),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied", 95, 0.95),
    ("perl", "you can redistribute it and/or modify it under the same terms as perl", 97, 0.95),
    ("ruby", "you can redistribute it and/or modify it under either the terms of the 2-clause bsdl", 97, 0.95),
    ("php", "this product includes php software, freely available from", 90, 0.9),
    ("postgresql", "in no event shall the university of california be liable to any party for direct, indirect, special", 85, 0.8),
    ("upl", "the universal permissive license (upl), version #", 95, 0.95),
    ("cecill", "this software is governed by the cecill license under french law", 95, 0.95),
    ("eupl", "licensed under the eupl, version #", 96, 0.97),
    ("busl", "use of this software is governed by the business source license", 95, 0.95),
    ("elastic", "licensed under the elastic license ... you may not use this file except in compliance with the elastic license", 97, 0.95),
    ("sspl", "this program is free software ... under the terms of the server side public license, version #", 97, 0.97),
    ("proprietary", "unauthorized copying of this file, via any medium is strictly prohibited", 90, 0.9),
    ("proprietary", "proprietary and confidential", 60, 0.7),
    ("bsd", "bsd-style license", 55, 0.7),
    ("mit", "mit-style license", 55, 0.7),
)
#: What may stand between the words of a name: white space, and the signs that comments begin their lines with.
BETWEEN, MAYBE = r"[\s*#/;]{1,8}", r"[\s*#/;]{0,8}"
GAP = r"[^a-z0-9\x80-\U0010ffff]{1,16}"


# Names that are no words of their own, and count only where a license is spoken of.
SHORT = ("mit", "expat", "isc", "zlib", "x11")
# Names that a list of licenses of one work may hold after its first.
DUAL = (("mit", "mit"), ("apache", "apache"), ("gpl", "gpl"), ("lgpl", "lgpl"), ("mpl", "mpl"), ("bsd", "bsd"))


def short_forms() -> Iterator[tuple[str, str, str, int, float]]:
    """(label, keyword, regex, priority, confidence) of the short ways in which licenses are named."""
    given = rf"(?:licen[sc]ed|released|distributed|published|available|provided|offered|shared){BETWEEN}under{BETWEEN}(?:the{BETWEEN})?(?:terms{BETWEEN}of{BETWEEN}(?:the{BETWEEN})?)?"
    number = r"(\d(?:\.\d)?)(?![\d.]?\d)"
    for n in SHORT:
        yield n, f"{n} licen", rf"\blicen[sc]e[sd]?[\"']?{MAYBE}[:=]{MAYBE}[\"'(\[]{{0,2}}{n}\b", 82, 0.9
        yield n, f"{n} under", rf"\b{given}{n}\b", 88, 0.9
        yield n, f"{n} licen", rf"\b{n}[\s-]{{1,3}}licen[sc]ed\b", 75, 0.85
    for label, n in DUAL:
        yield label, f"{n} dual licen", rf"\bdual(?:ly)?[\s-]{{1,3}}licen[sc]ed{BETWEEN}(?:under|as|with){BETWEEN}(?:[^.;]|\.(?=\d)){{1,80}}?\b{n}\b{VERSION}", 66, 0.85
    for n in ("gpl", "lgpl", "agpl"):
        yield n, n, rf"\b(?:gnu{BETWEEN})?{n}[\s-]{{0,2}}(?:version{BETWEEN}|ver\.?{MAYBE}|v\.?{MAYBE}){number}(?:\+|-or-later|-only)?", 72, 0.85
        yield n, f"gnu {n}", rf"\bgnu{BETWEEN}{n}\b", 55, 0.75
    for label, _, _, spdx, _ in FAMILIES:  # SPDX identifiers with a version, wherever they stand
        if r"\d[.\d]*" in spdx and "|" not in spdx.replace("(?:-only|-or-later|\\+)?", ""):
            head = spdx[: spdx.index(r"\d")]
            yield label, head, rf"(?<![\w.-]){head}{number}(?:-only|-or-later|\+)?", 84, 0.9
    for label, *_ in COMMONS:
        yield label, "cc-by", rf"(?<![\w.-]){label}-{number}", 99, 0.95
    yield "cc0", "cc0", rf"\bcc0[\s-]{{1,2}}{number}(?:{BETWEEN}universal\b)?", 85, 0.9
    yield "epl", "eclipse", rf"\beclipse{BETWEEN}public{BETWEEN}licen[sc]e{MAYBE}-{MAYBE}v(?:ersion|\.)?{MAYBE}{number}", 70, 0.85
    yield "unlicense", "unlicense", r"\bunlicense\b", 55, 0.7
    yield "wtfpl", "wtfpl", r"\bwtfpl\b", 55, 0.75
    yield "all-rights-reserved", "rights reserved", rf"\ball{BETWEEN}rights{BETWEEN}reserved\b", 30, 0.5


@dataclass(frozen=True)
class Rule:
    """A signature: every match of its regex over lower-cased text holds each word of keyword."""

    label: str
    keyword: str
    source: str
    priority: int
    confidence: float

    @functools.cached_property
    def pattern(self) -> re.Pattern:
        """Compiled when a text first holds the rule's words."""
        return re.compile(self.source)


def rules() -> list[Rule]:
    """Every rule in order: by falling priority, then as in the tables."""
    out = []

    def add(label, keyword, pattern, priority, confidence):
        out.append(Rule(label, keyword, pattern, priority, confidence))

    for label, phrase, priority, confidence in BODIES:
        add(label, *signature(phrase), priority, confidence)
    for n in "234":
        for form in (rf"\bbsd[\s-]{{1,3}}{n}[\s-]{{1,3}}clause\b", rf"\b{n}[\s-]{{1,3}}clause[\s-]{{1,3}}bsd\b"):
            add(f"bsd-{n}-clause", "bsd clause", form, 92, 0.85)
    for label, keyword, name, _, web in FAMILIES:
        gap = name.replace("[ -]", r"[\s-]").replace(" ", BETWEEN)
        for t, p, c in TEMPLATES:
            if keyword == "apache" and t.startswith(r"\b(?:subject"):  # "under apache" alone is said of other things as well
                t = t.replace("{name}", "{name}" + rf"(?=[\s,(]{{1,3}}(?:version |v\.? ?)?\d|{BETWEEN}licen)")
            add(label, keyword, t.replace(" ?", MAYBE).replace(" ", BETWEEN).replace("{name}", f"(?:{gap})").replace("{version}", VERSION), p, c)
        if "licen[sc]e" in name and not name.endswith(")?"):
            t, p, c = BARE
            add(label, keyword, t.replace("{name}", f"(?:{gap})").replace("{version}", VERSION), p, c)
        t, p, c = WEB
        add(label, "://" if keyword not in web.replace("\\", "") else keyword, t.replace("(?:https?://)?", "https?://" if keyword not in web.replace("\\", "") else "(?:https?://)?").replace("{web}", f"(?:{web})"), p, c)
    for label, *parts in COMMONS:
        short = r"cc[\s-]{1,2}by" + "".join(rf"[\s-]{{1,2}}{x}" for x in parts)
        long = rf"creative{BETWEEN}commons{BETWEEN}attribution" + "".join(rf"[\s-]{{1,3}}{LONG[x]}" for x in parts)
        for keyword, name, p in (("cc", short, 85), ("creative commons", long, 86)):
            add(label, keyword, rf"\b{name}\b{VERSION}", p + len(parts) * 2, 0.9)
            add(label, keyword, rf"\b(?:licen[sc]ed|released|distributed|published|available|provided){BETWEEN}under{BETWEEN}(?:an?{BETWEEN}|the{BETWEEN})?{name}\b{VERSION}", p + 10 + len(parts) * 2, 0.95)
        add(label, "creativecommons", rf"creativecommons\.org/licenses/{label[3:]}/(\d(?:\.\d)?)?", 95, 1.0)
    for rule in short_forms():
        add(*rule)
    return sorted(out, key=lambda r: -r.priority)


def signature(phrase: str) -> tuple[str, str]:
    """The words that any match of a phrase of BODIES holds, and its regex."""
    parts, words = [], []
    for w in phrase.split():
        if w == "...":
            parts.append(r".{1,200}?")
        elif w == "#":
            parts.append(r"(\d(?:\.\d)?)(?![\d.]?\d)")
        else:
            forms = [GAP.join(map(re.escape, re.findall(r"[a-z0-9]+", x))) for x in w.split("|")]
            parts.append(f"(?:{'|'.join(forms)})" if len(forms) > 1 else forms[0])
            words += re.findall(r"[a-z0-9]{4,}", w) if len(forms) == 1 else []
    text = parts[0]
    for before, part in zip(parts, parts[1:], strict=False):
        text += part if ".{1," in before + part else GAP + part
    return " ".join(sorted(set(words), key=lambda x: (-len(x), x))[:4]), rf"(?s)\b{text}" + ("" if phrase.endswith("#") else r"\b")


@functools.cache
def operand_label(token: str) -> str | None:
    """The label of an SPDX identifier; None for unknown ones."""
    for label, *_ in COMMONS:
        if m := re.fullmatch(rf"{label}-(\d(?:\.\d)?)", token):
            return f"{label}-{m[1]}"
    for label, _, _, spdx, _ in FAMILIES:
        if re.fullmatch(spdx, token):
            version = re.search(r"-(\d(?:\.\d)?)(?!\d)", token)
            return "bsd" + token[3:] if label == "bsd" else label + (f"-{version[1]}" if version and label not in ("ms-pl", "ms-rl", "unicode") else "")
    return None


class Intervals:
    """Intervals of which none is inside another, by rising starts and so by rising ends."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def holds(self, start: int, end: int) -> bool:
        k = bisect.bisect_right(self.starts, start) - 1
        return k >= 0 and self.ends[k] >= end

    def add(self, start: int, end: int):
        i = bisect.bisect_left(self.starts, start)
        j = bisect.bisect_right(self.ends, end)
        self.starts[i:j], self.ends[i:j] = [start], [end]


class Scanner:
    """The rules, grouped by the words that they need; without gated all are tried."""

    def __init__(self, found: list[Rule] | None = None, gated: bool = True):
        self.gated = gated
        self.by_words: dict[tuple[str, ...], list[tuple[int, Rule]]] = {}
        for k, r in enumerate(rules() if found is None else found):
            self.by_words.setdefault(tuple(r.keyword.split()), []).append((k, r))
        self.phrases = {tuple(p.split()): label for p, label in BASE.items()}
        # of each rule its longest word, by which most texts are passed over
        self.anchors = sorted({max(k, key=len).encode() for k in self.by_words if k not in (("cc",), ("://",)) and k[-1] != "under"} | {b"spdx"})
        self.pattern = re.compile(rb"cc[^a-z0-9\x80-\xff]+by|cc[^a-z0-9]{1,6}by|gnu[^a-z0-9\x80-\xff]+general|licenses?/|://[^\s]{0,60}licen|\bunder[\s*#/;]{1,8}(?:the[\s*#/;]{1,8})?(?:terms[\s*#/;]{1,8}of[\s*#/;]{1,8}(?:the[\s*#/;]{1,8})?)?(?:" + "|".join(SHORT).encode() + rb")\b")

    def gate(self, low: bytes) -> bool:
        """Whether any rule or base phrase can match."""
        return not self.gated or b"license" in low or any(a in low for a in self.anchors) or b"://" in low or bool(self.pattern.search(low))

    def detect(self, low: str) -> list[tuple[int, int, str, float]]:
        """(start, end, label, confidence) that no other detection suppresses, by position."""
        found = []
        known: dict[str, bool] = {}

        def has(word):
            if word not in known:
                known[word] = word in low
            return known[word]

        for words, own in self.by_words.items():
            if not self.gated or all(map(has, words)):
                for k, r in own:
                    for m in r.pattern.finditer(low):
                        version = next((g for g in m.groups() if g), None)
                        found.append((-r.priority, m.start() - m.end(), m.start(), k, m.end(), r.label + (f"-{version}" if version else ""), r.confidence))
        if not self.gated or has("spdx"):
            for m in SPDX.finditer(low):
                before = ""
                for o in OPERAND.finditer(low, m.start(1), m.end(1)):
                    token = o[0].rstrip(".-")
                    label = operand_label(token) if before != EXCEPT and token not in JOINS else None
                    if label:
                        found.append((-SPDX_PRIORITY, -len(token), o.start(), 0, o.start() + len(token), label, 1.0))
                    before = token
        held = Intervals()
        kept: list[tuple[int, int, str, float]] = []
        for _, _, start, _, end, label, confidence in sorted(found):
            if not held.holds(start, end):
                held.add(start, end)
                kept.append((start, end, label, confidence))
        return sorted(kept)

    def base(self, low: str) -> list[tuple[int, str]]:
        """(first word, label) of every place of a base phrase."""
        words = WORD.findall(low)
        places = []
        for phrase, label in self.phrases.items():
            at = -1
            for _ in range(words.count(phrase[0])):
                at = words.index(phrase[0], at + 1)
                if tuple(words[at : at + len(phrase)]) == phrase:
                    places.append((at, label))
        return sorted(places)


def lower(text: str) -> str:
    """A-Z lower-cased, everything else as it is."""
    return text.translate({c: c + 32 for c in range(65, 91)})


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("confidence", pa.float64())]))
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in pieces(offsets):
            part, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            n = np.diff(K.words(part, o, K.ALNUM)[2]).astype(np.int64)
            low = fold[part].tobytes()
            rows = [(0, None, None, "", "", 0.0, [])] * (j - i)
            if scanner.gate(low):
                for d in range(j - i):
                    own = low[o[d] : o[d + 1]]
                    if not scanner.gate(own):
                        continue
                    text = own.decode()
                    base, found = scanner.base(text), scanner.detect(text)
                    labels = {x[1] for x in base}
                    rows[d] = (len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted(labels)), ",".join(sorted(labels | {x[2] for x in found})), max([0.7 * bool(base), *(x[3] for x in found)]), [dict(zip(("start", "end", "label", "confidence"), x, strict=True)) for x in found])
            cols = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), spans)
            yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(n), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row.

    labels: the base phrases' and the rules', which may carry a version ('gpl-3'); score: the
    highest confidence among them, 0 without any; spans: the rules' detections in characters. Null
    and empty texts have no words, empty labels and score 0. Each row is scanned alone: repeated
    rows and null ids get rows of their own. Other columns are not carried.
    """
    raw = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    out = in_batches(raw, _scan, f"id {dict(raw.dtypes)['id']}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<start:bigint,end:bigint,label:string,confidence:double>>")
    return out.withColumnRenamed("id", doc_id)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and signatures of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))
