"""License scans by sentence rules.

Sentences of a text are normalised and looked up among known licence
sentences; the sequence of their identifiers is matched against ordered
rules, longest rule first. Known sentences that no rule takes are reported
as unmatched, so a new wording shows instead of passing silently.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded_batches, column

_BY = r"(?:this (?:file|work|project|software|code) is )?(?:released|licensed|distributed|available|provided) under (?:the terms of )?(?:the )?"
_FREE = r"this (?:program|library|software|file) is free software,? you can redistribute it and or modify it under the terms of the gnu "
_FSF = r"general public license,? (?P<same>version (?P<v1>[1-3](?:\.[01])?),? )?as published by the free software foundation"
# Licence sentences as their licences word them, by identifier. Names of licences vary in
# brackets of alternatives; <any> stands for any text of the sentence (a year, an owner).
SENTENCES = {
    "apache_by": r"(?:this (?:file|work|project|software|code) is )?(?:released|licensed|distributed) under the apache license,? version 2(?:\.0)?(?: the license)?",
    "apache_use": r"you may not use this file except in compliance with the license",
    "apache_copy": r"you may obtain a copy of the license at",
    "apache_asis": r"unless required by applicable law or agreed to in writing,? software distributed under the license is distributed on an as is basis,? without warranties or conditions of any kind,? either express or implied",
    "apache_see": r"see the license for the specific language governing permissions and limitations under the license",
    "mit_by": _BY + r"(?:mit|expat) license",
    "mit_grant": r"permission is hereby granted,? free of charge,? to any person obtaining a copy of this software and associated documentation files <any>to deal in the software without restriction",
    "mit_notice": r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_asis": r"the software is provided as is,? without warranty of any kind",
    "isc_by": _BY + r"isc license",
    "isc_grant": r"permission to use,? copy,? modify,? and(?: or)? distribute this software for any purpose with or without fee is hereby granted,? provided that the above copyright notice and this permission notice appear in all copies",
    "zero_grant": r"permission to use,? copy,? modify,? and(?: or)? distribute this software for any purpose with or without fee is hereby granted(?!,? provided)",
    "isc_asis": r"the software is provided as is and (?:the author|isc) disclaims all warranties",
    "zlib_asis": r"this software is provided as is,? without any express or implied warranty",
    "zlib_grant": r"permission is granted to anyone to use this software for any purpose",
    "unlicense_free": r"this is free and unencumbered software released into the public domain",
    "unlicense_any": r"anyone is free to copy,? modify,? publish,? use,? compile,? sell,? or distribute this software",
    "unlicense_by": _BY + r"unlicense",
    "boost_by": _BY + r"boost software license(?:,? version 1\.0)?",
    "bsd_by": _BY + r"(?P<id>(?:simplified |new |revised |modified |original |2 clause |3 clause |4 clause )?)bsd license",
    "bsd_redistribute": r"redistribution and use in source and binary forms,? with or without modification,? are permitted provided that the following conditions are met",
    "bsd_source": r"(?:1 )?redistributions of source code must retain the above copyright notice",
    "bsd_binary": r"(?:2 )?redistributions in binary form must reproduce the above copyright notice",
    "bsd_advert": r"(?:3 )?all advertising materials mentioning features or use of this software must display the following acknowledge?ment",
    "bsd_endorse": r"(?:[34] )?neither the name of <any>may be used to endorse or promote products",
    "gpl_by": _BY + r"(?P<id>gnu (?:affero |lesser |library )?general public license),? (?:v|version )(?P<version>[123](?:\.[01])?)(?P<later>,? or (?:\(?at your option\)? )?(?:any )?later(?: version)?)?",
    "gpl_short": _BY + r"(?:gnu )?(?P<id>[al]?gpl),? ?(?:v|version )?(?P<version>[123](?:\.[01])?)(?P<later>\+| or later|,? or (?:any )?later(?: version)?)?",
    "gpl_free": _FREE + r"(?P<id>affero |lesser |library )?" + _FSF + r"(?:,? (?:either )?version (?P<v2>[1-3](?:\.[01])?) (?:of the license)?)?(?P<later>,? or,? (?:at your option,? )?any later version)?",
    "gpl_hope": r"this (?:program|library|software|file) is distributed in the hope that it will be useful,? but without any warranty",
    "gpl_copy": r"you should have received a copy of the gnu (?:affero |lesser |library )?general public license",
    "cc_by": r"(?:this (?:file|work|project|software|code) is )?licensed under (?:a |the )?(?:cc|creative commons) (?P<id>by(?: (?:nc|nd|sa))*)(?: license)?(?: (?P<version>[1-4]\.[0-9]))?(?: international)?(?: license)?",
    "cc_words": r"creative commons attribution(?P<id>(?: non ?commercial| share ?alike| no ?deriv(?:ative)?s?(?: works)?)*)(?: (?P<version>[1-4]\.[0-9]))?(?: (?:international|unported|generic))?(?: public)?(?: license)?",
    "cc0": r"cc0 1\.0(?: universal)?",
    "cc0_waived": r"to the extent possible under law,? <any>has waived all copyright",
    "mpl_by": r"this source code form is subject to the terms of the mozilla public license,? v(?:ersion)? ?\.? ?2\.0",
    "reserved": r"all rights reserved",
    "copyright": r"(?P<years>(?:copyright|c) (?:c )?[0-9]{4}(?: [0-9]{4})?)(?:,? .*)?",
}
#: Fixed values. Ordered rules: a licence, and the identifiers that must follow each other. Longest first.
RULES = [
    ("Apache-2.0", ["apache_by", "apache_use", "apache_copy", "apache_asis", "apache_see"]),
    ("BSD-4-Clause", ["bsd_redistribute", "bsd_source", "bsd_binary", "bsd_advert", "bsd_endorse"]),
    ("BSD-4-Clause", ["bsd_redistribute", "bsd_source", "bsd_binary", "bsd_advert"]),
    ("BSD-3-Clause", ["bsd_redistribute", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSD-2-Clause", ["bsd_redistribute", "bsd_source", "bsd_binary"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_asis"]),
    ("{gpl}", ["gpl_free", "gpl_hope", "gpl_copy"]),
    ("Apache-2.0", ["apache_by", "apache_use"]),
    ("MIT", ["mit_grant", "mit_asis"]),
    ("ISC", ["isc_grant", "isc_asis"]),
    ("0BSD", ["zero_grant", "isc_asis"]),
    ("Zlib", ["zlib_asis", "zlib_grant"]),
    ("Unlicense", ["unlicense_free", "unlicense_any"]),
    ("{gpl}", ["gpl_free"]),
    ("Apache-2.0", ["apache_by"]),
    ("MIT", ["mit_by"]),
    ("ISC", ["isc_by"]),
    ("ISC", ["isc_grant"]),
    ("0BSD", ["zero_grant"]),
    ("Zlib", ["zlib_grant"]),
    ("Unlicense", ["unlicense_free"]),
    ("Unlicense", ["unlicense_by"]),
    ("BSL-1.0", ["boost_by"]),
    ("{bsd}", ["bsd_by"]),
    ("{gpl}", ["gpl_by"]),
    ("{gpl}", ["gpl_short"]),
    ("CC-{cc}", ["cc_by"]),
    ("CC-{cc}", ["cc_words"]),
    ("CC0-1.0", ["cc0"]),
    ("CC0-1.0", ["cc0_waived"]),
    ("MPL-2.0", ["mpl_by"]),
    ("{spdx}", ["spdx"]),
]
#: Sentences that may stand between those of one licence.
BETWEEN = {"copyright", "reserved"}
#: Licences that ask nothing of the text that is trained on beyond notices (Attribution licences of any version too).
PERMISSIVE = {"Apache-2.0", "MIT", "MIT-0", "BSD", "BSD-1-Clause", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "Unlicense", "BSL-1.0", "CC0-1.0",
              "X11", "NCSA", "PostgreSQL", "Python-2.0"}
ATTRIBUTION = re.compile(r"CC-BY(?:-[1-4]\.[0-9])?")
#: Other identifiers of the SPDX list, for their case.
SPDX = PERMISSIVE | {"BSD-4-Clause", "MPL-2.0", "EPL-1.0", "EPL-2.0", "Artistic-2.0", "EUPL-1.2", "CDDL-1.0", "OFL-1.1", "WTFPL", "Apache-1.1"}
SPDX |= {f"{letter}GPL-{v}{end}" for letter, vs in (("", ("1.0", "2.0", "3.0")), ("L", ("2.0", "2.1", "3.0")), ("A", ("1.0", "3.0"))) for v in vs for end in ("", "-only", "-or-later")}
BY_CASE = {x.lower(): x for x in SPDX}
#: A tag, and the parts of its expression: brackets and words.
TAG = re.compile(r"SPDX-License-Identifier\s*:\s*(.*)", re.I)
PART = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
#: A wording with text of any length within is looked for by its two ends.
KNOWN = [(k, [re.compile(x) for x in p.split("<any>")]) for k, p in SENTENCES.items()]
#: Wordings that take a whole line; all others may stand within a longer sentence.
BY_LINE = {k: p[0] for k, p in KNOWN if k == "copyright"}
#: Wordings that name a licence; words before them can deny it.
NAMED = {"apache_by", "mit_by", "isc_by", "unlicense_by", "boost_by", "bsd_by", "gpl_by", "gpl_short", "cc_by", "cc_words", "cc0", "mpl_by"}
CLAUSE = re.compile(r",|\b(?:but|instead|rather|although|though|because|whereas|while|yet|if|when)\b")
#: How many words before it can deny it.
REACH = 8
DENIED = re.compile(r"\b(?:not(?! only\b)|never|cannot|neither|nor|no|none|nothing|n t|[a-z]+n t)\b")
#: A sentence is looked up only if it holds one of these words.
HINT = re.compile(r"licen[cs]e|copyright|permission|redistribut|warrant|rights\W+reserved|free\W+software|cc0|creative\W+commons|endorse|\(c\)"
                  r"|gpl|public\W+domain|advertising\W+materials|anyone\W+is\W+free", re.I)
#: Sentences end at a full stop or at a line without a word (a blank one, or only a comment leader), not where a line is wrapped.
BREAK = re.compile(r"\n(?:[^\w\n]*\n)+|(?<=[.!?])[^\w\s]*\s+(?!\d)")
JUNK = re.compile(r"[^\w.+,]+|(?<!\d)\.|\.(?!\d)", re.UNICODE)


def normalised(sentence: str) -> str:
    """Lower case, words and version numbers only, one space between them; licences with an s."""
    words = JUNK.sub(" ", sentence.lower()).replace(",", " , ").split()
    return " ".join(words).replace(" ,", ",").strip(" ,").replace("licence", "license")


def permissive(name: str) -> bool:
    """Whether a licence asks for notices only; an exception (``WITH``) takes nothing away."""
    base = name.split(" WITH ")[0].rstrip("+")
    return base in PERMISSIVE or bool(ATTRIBUTION.fullmatch(base))


def expression(written: str) -> tuple[list[str], bool]:
    """(licences, permissive) of an SPDX expression: AND asks for all, OR lets choose, WITH binds first, then AND.

    It ends where the next word does not continue it. Brackets that stay open end with it.
    """
    parts, names = [m.rstrip(".:-") for m in PART.findall(written)], []
    stack: list[list[list[bool]]] = [[[]]]  # open brackets; in each the alternatives, in each what must hold together
    at, want = 0, True  # want: a licence or a bracket comes next
    while at < len(parts):
        p = parts[at]
        if want:
            if p == "(":
                stack.append([[]])
            elif p == ")" or p.upper() in ("AND", "OR", "WITH"):
                break
            else:
                name = BY_CASE.get(p.lower(), p)
                if at + 2 < len(parts) and parts[at + 1].upper() == "WITH" and parts[at + 2] not in "()":
                    name, at = f"{name} WITH {parts[at + 2]}", at + 2
                names.append(name)
                stack[-1][-1].append(permissive(name))
                want = False
        elif p == ")" and len(stack) > 1:
            inner = any(map(all, stack.pop()))
            stack[-1][-1].append(inner)
        elif p in ("AND", "OR") or p in ("and", "or") and at + 1 < len(parts) and (parts[at + 1] == "(" or parts[at + 1].lower() in BY_CASE):
            if p.upper() == "OR":
                stack[-1].append([])
            want = True
        else:
            break
        at += 1
    while True:
        held = any(all(x) for x in stack.pop() if x)
        if not stack:
            return names, held and bool(names)
        stack[-1][-1].append(held)


def licence_sentences(text: str | None) -> list[tuple[str, dict]]:
    """(identifier, named parts) of the known sentences of a text, in order."""
    if not text or not HINT.search(text):
        return []
    out = []
    for sentence in BREAK.split(text.replace("\r\n", "\n").replace("\r", "\n")):
        if sentence and HINT.search(sentence):
            out += [(k, parts) for _, _, k, parts in _matches(sentence)]
    return out


def _found(s: str, ends: list[re.Pattern]) -> Iterator[tuple[int, int, dict]]:
    """(start, end, named parts) of a wording. One of two ends takes the first tail after a head; the text is read once."""
    if len(ends) == 1:
        yield from ((m.start(), m.end(), m.groupdict()) for m in ends[0].finditer(s))
        return
    head, tail = ends
    at = 0
    while (first := head.search(s, at)) and (last := tail.search(s, first.end())):
        yield first.start(), last.end(), {}
        at = last.end()


def _matches(sentence: str) -> list[tuple[int, int, str, dict]]:
    """(start, -end, identifier, named parts) of all known wordings in a sentence, the longest of those that overlap at one start."""
    s, hits = normalised(sentence), []
    for k, ends in KNOWN:
        if k not in BY_LINE:
            hits += [(a, -b, k, parts) for a, b, parts in _found(s, ends)]
    words, first = [m.start() for m in re.finditer(r"\S+", s)], 0
    for raw in sentence.split("\n"):
        line = normalised(raw)
        if (tag := TAG.search(raw)) and (named := expression(tag[1]))[0]:
            before = len(normalised(raw[:tag.start()]).split())
            hits.append((words[first + before], -words[first] - len(line), "spdx", {"names": named[0], "free": named[1]}))
        elif m := BY_LINE["copyright"].fullmatch(line):
            # an owner's name can hold another wording, so only the years count as taken
            hits.append((words[first], -words[first] - m.end("years"), "copyright", {}))
        first += len(line.split())
    out, end = [], 0
    for a, b, k, parts in sorted(hits, key=lambda h: h[:2]):
        if a >= end:
            if k in NAMED:
                between, last = CLAUSE.split(s[end:a])[-1], out[-1][2] if out else ""
                if DENIED.search(" ".join(between.split()[-REACH:])) or last.startswith("not_") and between.strip() in ("or", "and"):
                    k = f"not_{k}"
            out.append((a, b, k, parts))
            end = -b
    return out


def _name(rule: str, parts: dict) -> str:
    own, version = (parts.get("id") or "").strip(), parts.get("version") or parts.get("v1") or parts.get("v2")
    if rule == "{bsd}":
        return {"simplified": "BSD-2-Clause", "2 clause": "BSD-2-Clause", "original": "BSD-4-Clause", "4 clause": "BSD-4-Clause"}.get(own, "BSD-3-Clause" if own else "BSD")
    if rule == "{gpl}":
        letter = "A" if "affero" in own or own == "agpl" else "L" if "lesser" in own or "library" in own or own == "lgpl" else ""
        end = "-or-later" if parts.get("later") else "-only" if "same" in parts and version else ""
        return f"{letter}GPL" + (f"-{version if '.' in version else version + '.0'}{end}" if version else "")
    if rule == "CC-{cc}":
        if not own.startswith("by"):
            marks = [("NC", r"non ?commercial"), ("ND", r"no ?deriv"), ("SA", r"share ?alike")]
            own = " ".join(["by"] + [m for m, p in marks if re.search(p, own)])
        return "CC-" + own.upper().replace(" ", "-") + (f"-{version}" if version else "")
    return rule


def _taken(ids: list[str], at: int, seq: list[str]) -> list[int]:
    """The places of a rule's identifiers from ``at`` on, only BETWEEN sentences between them; empty if it does not fit."""
    out = []
    for k in seq:
        while out and at < len(ids) and ids[at] != k and ids[at] in BETWEEN:
            at += 1
        if at >= len(ids) or ids[at] != k:
            return []
        out.append(at)
        at += 1
    return out


def licences(found: list[tuple[str, dict]]) -> tuple[list[str], list[str], bool | None]:
    """(licences in text order, known sentences that no rule took, whether all licences are permissive)."""
    names, rest, at, free = [], [], 0, True
    ids = [k for k, _ in found]
    while at < len(ids):
        for rule, seq in RULES:
            if ids[at] == seq[0] and (places := _taken(ids, at, seq)):
                parts = found[at][1]
                own = parts["names"] if rule == "{spdx}" else [_name(rule, parts)]
                free &= parts["free"] if rule == "{spdx}" else permissive(own[0])
                names += own
                rest += [ids[i] for i in range(at, places[-1]) if i not in places]
                at = places[-1] + 1
                break
        else:
            rest.append(ids[at])
            at += 1
    return names, rest, free if names else None


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sentences, licences, unmatched (arrays in text order), permissive for every row.

    ``permissive``: no licence found asks more than a notice (of an SPDX
    expression: by its AND and OR); null if none was found. A licence that its
    sentence denies ("is not licensed under ...") is no licence; it stands in
    ``unmatched`` as ``not_`` and the identifier. A null or empty text has no sentences. Repeated rows get equal
    results; other columns of ``docs`` are ignored.
    """

    @F.pandas_udf("sentences array<string>, licences array<string>, unmatched array<string>, permissive boolean")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                found = licence_sentences(text)
                names, rest, free = licences(found)
                rows.append(([k for k, _ in found], names, rest, free))
            yield pd.DataFrame(rows, columns=["sentences", "licences", "unmatched", "permissive"])

    bounded_batches(docs.sparkSession)
    return docs.select(column(docs, id_col).alias("doc_id"), look(column(docs, text_col)).alias("s")).select("doc_id", "s.*")
