"""License scans with ordered signature rules.

A rule is a regular expression over a text's words with the keywords that must occur before it
is tried, a label, a priority and a confidence. Digits in the words that it matched are the licence's version. Rules written for single licences stand beside
those made from a table of licences and a table of wordings; more can be added. Detections overlap: they are taken by
priority, then length, and one that lies within a detection taken before is dropped.

Three base phrases are found on their own and are never dropped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

# Label, name as a pattern over words, versions (empty: none), SPDX words, a keyword of the name.
FAMILIES = (
    ("mit", "(?:mit|expat|x11)", ("",), "mit", " mit | expat | x11 "),
    ("apache", "apache(?: software foundation)?", ("1 0", "1 1", "2 0"), "apache {}", "apache"),
    ("gpl", "(?:gnu )?(?:general public|gpl)", ("1", "2", "2 0", "3", "3 0"), "gpl {}", "general public|gpl"),
    ("lgpl", "(?:gnu )?(?:lesser general public|library general public|lgpl)", ("2", "2 1", "3", "3 0"), "lgpl {}", "lesser general|library general|lgpl"),
    ("agpl", "(?:gnu )?(?:affero general public|agpl)", ("1", "3", "3 0"), "agpl {}", "affero|agpl"),
    ("gfdl", "(?:gnu )?(?:free documentation|gfdl|fdl)", ("1 1", "1 2", "1 3"), "gfdl {}", "free documentation|fdl"),
    ("bsd", "(?:(?:new|modified|simplified|revised|original) )?bsd", ("0 clause", "1 clause", "2 clause", "3 clause", "4 clause"), "bsd {}", "bsd"),
    ("mpl", "mozilla public", ("1 0", "1 1", "2 0"), "mpl {}", "mozilla public"),
    ("epl", "eclipse public", ("1 0", "2 0"), "epl {}", "eclipse public"),
    ("cddl", "common development and distribution", ("1 0", "1 1"), "cddl {}", "common development"),
    ("cpl", "common public", ("0 5", "1 0"), "cpl {}", "common public"),
    ("isc", "isc", ("",), "isc", " isc "),
    ("zlib", "zlib(?: libpng)?", ("",), "zlib", "zlib"),
    ("unlicense", "unlicense", ("",), "unlicense", "unlicense"),
    ("artistic", "artistic", ("1 0", "2 0"), "artistic {}", "artistic"),
    ("bsl", "boost software", ("1 0",), "bsl {}", "boost software"),
    ("eupl", "european union public", ("1 0", "1 1", "1 2"), "eupl {}", "european union"),
    ("osl", "open software", ("1 0", "2 0", "2 1", "3 0"), "osl {}", "open software"),
    ("afl", "academic free", ("1 1", "1 2", "2 0", "2 1", "3 0"), "afl {}", "academic free"),
    ("ofl", "(?:sil )?open font", ("1 0", "1 1"), "ofl {}", "open font"),
    ("wtfpl", "(?:do what the fuck you want to public|wtfpl)", ("",), "wtfpl", "want to public|wtfpl"),
    ("psf", "python(?: software foundation)?", ("2", "2 0"), "psf {}", " python "),
    ("php", "php", ("3 0", "3 01"), "php {}", " php "),
    ("ms-pl", "microsoft public", ("",), "ms pl", "microsoft public"),
    ("ms-rl", "microsoft reciprocal", ("",), "ms rl", "microsoft reciprocal"),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", ("",), "ncsa", "ncsa"),
    ("zpl", "zope public", ("1 1", "2 0", "2 1"), "zpl {}", "zope public"),
    ("qpl", "q public", ("1 0",), "qpl {}", " q public "),
    ("lppl", "latex project public", ("1 0", "1 2", "1 3c"), "lppl {}", "latex project"),
    ("cecill", "cecill(?: [abc])?", ("1 0", "2 0", "2 1"), "cecill {}", "cecill"),
    ("postgresql", "postgresql", ("",), "postgresql", "postgresql"),
    ("upl", "universal permissive", ("1 0",), "upl {}", "universal permissive"),
    ("mulan", "mulan permissive", ("1", "2"), "mulanpsl {}", "mulan"),
    ("cc-by", "creative commons attribution", ("2 0", "2 5", "3 0", "4 0"), "cc by {}", "commons attribution"),
    ("cc-by-sa", "creative commons attribution share ?alike", ("2 0", "2 5", "3 0", "4 0"), "cc by sa {}", "commons attribution"),
    ("cc-by-nc", "creative commons attribution non ?commercial", ("2 0", "3 0", "4 0"), "cc by nc {}", "commons attribution"),
    ("cc-by-nd", "creative commons attribution no ?deriv\\w*", ("2 0", "3 0", "4 0"), "cc by nd {}", "commons attribution"),
    ("cc0", "(?:creative commons (?:zero|cc0)|cc0)", ("1 0",), "cc0 {}", " cc0 |creative commons"),
    ("proprietary", "(?:proprietary|commercial)", ("",), "licenseref proprietary", "proprietary|commercial"),
)

VERSIONED = {label for label, _, versions, *_ in FAMILIES if versions != ("",)}

# Wording, priority, confidence, keywords. {n} the name, {v} its versions, {s} the SPDX words. Words that
# hold the name are tried only where its keyword occurs too.
WITH_VERSION = (
    ("spdx licen[sc]e identifier {s}(?: (?:only|or later))?", 90, 1.0, ("spdx",)),
    ("{n} licen[sc]e(?: agreement)? (?:version|v) ?{v}", 80, 0.95, ("licen",)),
    ("{n} licen[sc]e {v}", 70, 0.9, ("licen",)),
    ("(?:licensed|released|distributed) under (?:the )?(?:terms of (?:the )?)?{n} (?:licen[sc]e )?(?:version |v )?{v}", 75, 0.95, ("under",)),
)
WITHOUT_VERSION = (
    ("spdx licen[sc]e identifier {s}", 85, 0.95, ("spdx",)),
    ("(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{n}(?: open source)? licen[sc]e", 60, 0.9, ("licen", "under")),
    ("under the {n} licen[sc]e", 50, 0.8, ("licen", "under")),
    ("{n} licen[sc]e", 40, 0.7, ("licen",)),
    ("licen[sc]e {n}", 30, 0.5, ("licen",)),
)
# Wordings of single licences: label, wording, priority, confidence, keywords.
SINGLE = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 95, 1.0, ("permission",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification", 95, 1.0, ("redistribution",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", 95, 1.0, ("permission",)),
    ("apache", "you may not use this file except in compliance with the license", 95, 0.95, ("compliance",)),
    ("gpl", "this program is free software you can redistribute it and or modify it", 94, 0.9, ("redistribute",)),
    ("lgpl", "this library is free software you can redistribute it and or modify it", 94, 0.9, ("redistribute",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", 95, 1.0, ("mozilla",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", 95, 1.0, ("unencumbered",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event", 93, 0.8, ("warranty",)),
    ("public-domain", "(?:released (?:in)?to|placed in(?:to)?|in) the public domain", 50, 0.6, ("public domain",)),
    ("proprietary", "all rights reserved", 10, 0.3, ("reserved",)),
    ("proprietary", "confidential and proprietary", 20, 0.5, ("proprietary",)),
)

# Short names, joined versions and versions before the licence, as each licence is called:
# label, wording, confidence, keywords. A keyword is rare but for the licence's texts.
SHORT = (
    ("mit", "licen[sc]ed under (?:the )?mit", 0.85, ("under", " mit ")),
    ("mit", "(?:mit x11|x11 mit|mit expat|expat mit)(?: style)? licen[sc]e", 0.9, (" mit ", "licen")),
    ("mit", "mit (?:style|type) licen[sc]e", 0.7, (" mit ", "licen")),
    ("mit", "(?:dual )?licen[sc]ed under (?:the )?(?:gpl[v ]*[23]? (?:and|or) )mit", 0.8, ("under", " mit ", "gpl")),
    ("apache", "apache (?:v|version )?(?:1 0|1 1|2 0|2) (?:software )?licen[sc]e", 0.95, ("apache",)),
    ("apache", "apache ?v2(?: 0)?", 0.9, ("apache",)),
    ("apache", "apache (?:1 0|1 1|2 0)", 0.8, ("apache",)),
    ("apache", "apache (?:software )?licen[sc]e(?: version| v)? ?2(?: 0)?", 0.9, ("apache",)),
    ("apache", "(?:asl|al)v? ?2 0", 0.6, ("licen", " asl| al", "2 0")),
    ("gpl", "(?:gnu )?gpl ?v ?[123](?: 0)?(?: only| or later| or any later version)?", 0.9, ("gpl",)),
    ("gpl", "(?:gnu )?gpl ?[123](?: 0)?(?: only| or later| or any later version)?", 0.85, ("gpl",)),
    ("gpl", "(?:gnu )?gpl version [123](?: 0)?(?: only| or later| or any later version)?", 0.9, ("gpl",)),
    ("gpl", "(?:version|v) ?[123](?: 0)? of the (?:gnu )?(?:gpl|general public licen[sc]e)", 0.9, ("of the", "gpl|general public")),
    ("gpl", "gnu general public licen[sc]e v ?[123](?: 0)?(?: only| or later)?", 0.95, ("general public",)),
    ("gpl", "(?:under|by) the (?:terms of the )?(?:gnu )?gpl", 0.8, ("gpl",)),
    ("gpl", "gnu gpl", 0.7, ("gnu gpl",)),
    ("lgpl", "(?:gnu )?lgpl ?v? ?(?:2 1|2 0|2|3 0|3)(?: only| or later)?", 0.9, ("lgpl",)),
    ("lgpl", "(?:gnu )?lgpl version (?:2 1|2|3)(?: 0)?(?: only| or later)?", 0.9, ("lgpl",)),
    ("lgpl", "(?:version|v) ?(?:2 1|2|3)(?: 0)? of the (?:gnu )?(?:lgpl|lesser general public licen[sc]e|library general public licen[sc]e)", 0.9, ("of the", "lgpl|general public")),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public licen[sc]e v ?(?:2 1|2|3)(?: 0)?", 0.95, ("general public",)),
    ("lgpl", "(?:under|by) the (?:terms of the )?(?:gnu )?lgpl", 0.8, ("lgpl",)),
    ("agpl", "(?:gnu )?agpl ?v? ?[13](?: 0)?(?: only| or later)?", 0.9, ("agpl",)),
    ("agpl", "(?:gnu )?affero (?:general public licen[sc]e|gpl) ?v? ?[13](?: 0)?", 0.95, ("affero",)),
    ("agpl", "(?:under|by) the (?:terms of the )?(?:gnu )?(?:agpl|affero gpl)", 0.8, ("agpl|affero",)),
    ("gfdl", "(?:gnu )?g?fdl ?v? ?1 [123](?: only| or later)?", 0.9, ("fdl",)),
    ("gfdl", "gnu free documentation licen[sc]e v ?1 [123]", 0.95, ("free documentation",)),
    ("bsd", "bsd [01234] clause(?: licen[sc]e)?", 0.95, ("bsd",)),
    ("bsd", "[01234] clause (?:new |modified |simplified |revised |original )?bsd(?: licen[sc]e)?", 0.95, ("bsd",)),
    ("bsd", "(?:one|two|three|four|zero) clause bsd(?: licen[sc]e)?", 0.95, ("bsd",)),
    ("bsd", "bsd (?:one|two|three|four|zero) clause(?: licen[sc]e)?", 0.95, ("bsd",)),
    ("bsd", "bsd[234](?: licen[sc]e)?", 0.8, ("bsd",)),
    ("bsd", "bsd (?:style|type|like) licen[sc]e", 0.7, ("bsd",)),
    ("bsd", "licen[sc]ed under (?:the )?(?:new |modified |simplified |revised )?bsd", 0.85, ("bsd",)),
    ("mpl", "mpl ?v? ?(?:1 0|1 1|2 0|2)", 0.9, (" mpl",)),
    ("mpl", "mozilla public licen[sc]e v ?(?:1 0|1 1|2 0|2)", 0.95, ("mozilla",)),
    ("mpl", "mozilla (?:public )?(?:1 0|1 1|2 0) licen[sc]e", 0.9, ("mozilla",)),
    ("epl", "epl ?v? ?[12](?: 0)?", 0.85, (" epl",)),
    ("epl", "eclipse public licen[sc]e v ?[12](?: 0)?", 0.95, ("eclipse",)),
    ("epl", "eclipse distribution licen[sc]e", 0.5, ("eclipse",)),
    ("cddl", "cddl ?v? ?1 [01]", 0.9, ("cddl",)),
    ("cddl", "(?:under|by) the (?:terms of the )?cddl", 0.85, ("cddl",)),
    ("cpl", "cpl ?v? ?(?:0 5|1 0)", 0.8, (" cpl",)),
    ("cpl", "common public licen[sc]e v ?(?:0 5|1 0)", 0.95, ("common public",)),
    ("isc", "isc (?:style|type) licen[sc]e", 0.7, (" isc ", "licen")),
    ("isc", "licen[sc]ed under (?:the )?isc", 0.85, ("under", " isc ")),
    ("zlib", "(?:zlib libpng|zlib png|libpng|zlib style) licen[sc]e", 0.85, ("lib", "licen")),
    ("zlib", "licen[sc]ed under (?:the )?zlib", 0.85, ("zlib",)),
    ("unlicense", "(?:under|to) the unlicen[sc]e", 0.95, ("unlicen",)),
    ("artistic", "artistic (?:1 0|2 0|2) licen[sc]e", 0.95, ("artistic",)),
    ("artistic", "artistic licen[sc]e v ?[12](?: 0)?", 0.95, ("artistic",)),
    ("artistic", "the same terms as perl(?: itself)?", 0.7, ("perl",)),
    ("bsl", "boost (?:software )?1 0 licen[sc]e", 0.95, ("boost",)),
    ("bsl", "boost (?:software )?licen[sc]e v ?1(?: 0)?", 0.95, ("boost",)),
    ("bsl", "bsl ?v? ?1 0", 0.85, (" bsl",)),
    ("eupl", "eupl ?v? ?1 [012]", 0.95, ("eupl",)),
    ("eupl", "european union public licen[sc]e v ?1 [012]", 0.95, ("european union",)),
    ("osl", "osl ?v? ?(?:1 0|2 0|2 1|3 0)", 0.9, (" osl",)),
    ("osl", "open software licen[sc]e v ?(?:1 0|2 0|2 1|3 0)", 0.95, ("open software",)),
    ("afl", "afl ?v? ?(?:1 1|1 2|2 0|2 1|3 0)", 0.85, (" afl",)),
    ("afl", "academic free licen[sc]e v ?(?:1 1|1 2|2 0|2 1|3 0)", 0.95, ("academic free",)),
    ("ofl", "(?:sil )?ofl ?v? ?1 [01]", 0.9, (" ofl",)),
    ("ofl", "(?:under|by) the (?:terms of the )?sil ofl", 0.9, (" ofl",)),
    ("wtfpl", "wtfpl(?: ?v? ?[12](?: 0)?)?", 0.9, ("wtfpl",)),
    ("psf", "psfl?(?: licen[sc]e)? ?v? ?2(?: 0)?", 0.8, (" psf",)),
    ("psf", "psf licen[sc]e", 0.8, (" psf",)),
    ("php", "php 3 01? licen[sc]e", 0.95, ("php",)),
    ("php", "php licen[sc]e v ?3 01?", 0.95, ("php",)),
    ("ms-pl", "(?:under|by) (?:the )?(?:terms of the )?ms pl", 0.9, ("ms pl",)),
    ("ms-pl", "ms pl licen[sc]e", 0.9, ("ms pl",)),
    ("ms-rl", "(?:under|by) (?:the )?(?:terms of the )?ms rl", 0.9, ("ms rl",)),
    ("ms-rl", "ms rl licen[sc]e", 0.9, ("ms rl",)),
    ("ncsa", "(?:uiuc|illinois) (?:ncsa )?(?:open source )?licen[sc]e", 0.85, ("licen", " uiuc | illinois ")),
    ("ncsa", "licen[sc]ed under (?:the )?(?:uiuc|ncsa)", 0.85, ("under", " uiuc | ncsa ")),
    ("zpl", "zpl ?v? ?(?:1 1|2 0|2 1)", 0.9, (" zpl",)),
    ("zpl", "zope public licen[sc]e v ?(?:1 1|2 0|2 1)", 0.95, ("zope",)),
    ("qpl", "qpl ?v? ?1 0", 0.85, (" qpl",)),
    ("qpl", "(?:under|by) the (?:terms of the )?qpl", 0.85, (" qpl",)),
    ("lppl", "lppl ?v? ?1 (?:0|1|2|3[abc]?)", 0.95, ("lppl",)),
    ("lppl", "latex project public licen[sc]e v ?1 (?:0|1|2|3[abc]?)", 0.95, ("latex",)),
    ("cecill", "cecill ?(?:[abc] )?v? ?(?:1 0|1|2 0|2 1)", 0.9, ("cecill",)),
    ("cecill", "(?:under|by) (?:the )?cecill(?: [abc])?", 0.85, ("cecill",)),
    ("postgresql", "postgres licen[sc]e", 0.85, ("postgres",)),
    ("postgresql", "licen[sc]ed under (?:the )?postgresql", 0.85, ("postgresql",)),
    ("upl", "upl ?v? ?1 0", 0.85, (" upl",)),
    ("upl", "universal permissive licen[sc]e v ?1(?: 0)?", 0.95, ("universal permissive",)),
    ("mulan", "mulan ?psl ?v? ?[12]", 0.95, ("mulan",)),
    ("mulan", "mulan (?:permissive software|permissive|psl) licen[sc]e ?v? ?[12]", 0.95, ("mulan",)),
    ("cc-by", "cc by(?: (?:1 0|2 0|2 5|3 0|4 0))?(?! (?:sa|nc|nd)(?![^ ]))(?: international| unported| licen[sc]e)*", 0.9, ("cc by",)),
    ("cc-by", "creative commons (?:attribution|by) (?:1 0|2 0|2 5|3 0|4 0)(?: international| unported| generic)?(?: public)? licen[sc]e", 0.95, ("creative commons",)),
    ("cc-by-sa", "cc by sa(?: (?:1 0|2 0|2 5|3 0|4 0))?(?: international| unported| licen[sc]e)*", 0.95, ("cc by sa",)),
    ("cc-by-sa", "creative commons (?:attribution share ?alike|by sa) (?:1 0|2 0|2 5|3 0|4 0)(?: international| unported| generic)?(?: public)? licen[sc]e", 0.95, ("creative commons",)),
    ("cc-by-nc", "cc by nc(?! (?:sa|nd)(?![^ ]))(?: (?:1 0|2 0|2 5|3 0|4 0))?(?: international| unported| licen[sc]e)*", 0.95, ("cc by nc",)),
    ("cc-by-nc", "creative commons (?:attribution non ?commercial|by nc) (?:1 0|2 0|2 5|3 0|4 0)(?: international| unported| generic)?(?: public)? licen[sc]e", 0.95, ("creative commons",)),
    ("cc-by-nd", "cc by nd(?: (?:1 0|2 0|2 5|3 0|4 0))?(?: international| unported| licen[sc]e)*", 0.95, ("cc by nd",)),
    ("cc-by-nd", "creative commons (?:attribution no ?deriv\\w*|by nd) (?:1 0|2 0|2 5|3 0|4 0)(?: international| unported| generic)?(?: public)? licen[sc]e", 0.95, ("creative commons",)),
    ("cc-by-nc-sa", "cc by nc sa(?: (?:1 0|2 0|2 5|3 0|4 0))?(?: international| unported| licen[sc]e)*", 0.95, ("cc by nc sa",)),
    ("cc-by-nc-sa", "creative commons (?:attribution non ?commercial share ?alike|by nc sa)(?: (?:1 0|2 0|2 5|3 0|4 0))?(?: international| unported| generic)?(?: public)? licen[sc]e", 0.95, ("creative commons",)),
    ("cc-by-nc-nd", "cc by nc nd(?: (?:1 0|2 0|2 5|3 0|4 0))?(?: international| unported| licen[sc]e)*", 0.95, ("cc by nc nd",)),
    ("cc-by-nc-nd", "creative commons (?:attribution non ?commercial no ?deriv\\w*|by nc nd)(?: (?:1 0|2 0|2 5|3 0|4 0))?(?: international| unported| generic)?(?: public)? licen[sc]e", 0.95, ("creative commons",)),
    ("cc0", "cc ?0 1 0(?: universal)?(?: public domain dedication)?", 0.95, (" cc0 1 0| cc 0 1 0",)),
    ("cc0", "(?:under|to|by) (?:the )?(?:creative commons )?(?:cc0|cc zero)", 0.9, (" cc0 | cc zero ",)),
    ("cc0", "creative commons (?:zero|cc0) (?:v ?)?1(?: 0)?(?: universal)?(?: licen[sc]e)?", 0.95, ("creative commons",)),
    ("proprietary", "end user licen[sc]e agreement", 0.5, ("end user",)),
)
SHORT_PRIORITY = 72


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    priority: int
    confidence: float
    keywords: tuple[str, ...]  # all must occur; of one with bars, any part


# The version in a match's words: after a space, a "v" or a short name, as in "gplv3" or "bsd3".
VERSION = re.compile(rb"(?:(?<= )|(?<=v)|(?<=[dl])|^)(\d+(?: \d+[a-z]?)?)(?![^ ])")


def version_of(label: str, words: bytes) -> str | None:
    """The label with the version that the words of a detection name; None without one."""
    found = VERSION.findall(words)
    if not found or label not in VERSIONED:
        return None
    version = found[-1].decode().replace(" ", ".")
    if label == "bsd":
        return f"bsd-{version}-clause"
    return f"{label}-{version if '.' in version else version + '.0'}"


def rules() -> list[Rule]:
    """All rules, highest priority first."""
    out = [Rule(*s) for s in SINGLE]
    out += [Rule(label, wording, SHORT_PRIORITY, sure, keys) for label, wording, sure, keys in SHORT]
    for label, name, versions, spdx, named in FAMILIES:
        for wording, priority, sure, keys in WITHOUT_VERSION:
            words = spdx.replace("{}", "").strip()
            keys = keys if "{n}" not in wording else (*keys, named)
            out.append(Rule(label, wording.format(n=name, s=words), priority, sure, keys))
        if label not in VERSIONED:
            continue
        known = "(?:" + "|".join(sorted(versions, key=len, reverse=True)) + ")"
        for wording, priority, sure, keys in WITH_VERSION:
            keys = keys if "{n}" not in wording else (*keys, named)
            out.append(Rule(label, wording.format(n=name, v=known, s=spdx.format(known)), priority, sure, keys))
    return sorted(out, key=lambda r: (-r.priority, r.label, r.pattern))


class Scanner:
    """Compiled rules; made once on each worker."""

    def __init__(self, ordered: list[Rule]):
        whole = lambda p: re.compile(f"(?<![^ ])(?:{p})(?![^ ])".encode())
        self.rules = [(r, whole(r.pattern), tuple(r.keywords)) for r in ordered]
        self.base = [(f" {p} ".encode(), label) for p, label in BASE.items()]
        # Rules with the same keywords are tried or left together.
        self.gated: dict[tuple, list] = {}
        for rule, pattern, keys in self.rules:
            gate = tuple(tuple(part.encode() for part in k.split("|")) for k in keys)
            self.gated.setdefault(gate, []).append((rule, pattern))
        self.hints = sorted({part for gate in self.gated for k in gate for part in k})

    def scan(self, text: str | None) -> tuple:
        """n_words, base places (word, label), detections (first, last, label, confidence, version)."""
        words = (text or "").encode("utf-8", "surrogatepass").translate(WORDS).split()
        padded = b" " + b" ".join(words) + b" "
        at = [(m, label) for phrase, label in self.base for m in places(padded, phrase)]
        present = {k for k in self.hints if k in padded}
        found = []
        for gate, tried in self.gated.items():
            if all(not present.isdisjoint(parts) for parts in gate):
                for rule, pattern in tried:
                    found += [(rule.priority, m.start(), m.end(), rule) for m in pattern.finditer(padded)]
        if not at and not found:
            return len(words), [], []
        spaces = np.flatnonzero(np.frombuffer(padded, np.uint8) == 32)[1:]
        word_at = lambda offset: int(np.searchsorted(spaces, offset))
        found.sort(key=lambda f: (-f[0], f[1] - f[2], f[1], f[3].label))
        return len(words), [(word_at(m + 1), label) for m, label in at], [
            (word_at(a), word_at(b - 1), r.label, r.confidence, version_of(r.label, padded[a:b]))
            for _, a, b, r in outermost(found)
        ]


def places(text: bytes, phrase: bytes) -> list[int]:
    """All places of a phrase, those that overlap too."""
    out, at = [], text.find(phrase)
    while at >= 0:
        out.append(at)
        at = text.find(phrase, at + 1)
    return out


def outermost(found: list[tuple]) -> list[tuple]:
    """Detections, in their order, that don't lie within one kept before.

    A tree over the starts holds the farthest end of the detections kept, so each is judged in
    the logarithm of their number.
    """
    place = {a: i for i, a in enumerate(sorted({f[1] for f in found}), 1)}
    farthest = [-1] * (len(place) + 1)
    kept = []
    for f in found:
        at, b = place[f[1]], f[2]
        reach, i = -1, at
        while i:  # the kept ones that start here or before
            reach = max(reach, farthest[i])
            i &= i - 1
        if reach >= b:
            continue
        kept.append(f)
        while at < len(farthest):
            farthest[at] = max(farthest[at], b)
            at += at & -at
    return kept


def scanned(docs: DataFrame, ordered: list[Rule] | None = None) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, versions,
    detections`` of every row.

    Words: runs of ASCII letters and digits and of other characters above ASCII, A-Z
    lower-cased, numbered from 0. Base columns count the places of the base phrases;
    ``labels`` adds the rules' labels, ``versions`` has those whose version is told, as in
    ``gpl-3.0`` (distinct, sorted, comma-joined). ``score``: the largest confidence found, 0.7 at least
    with a base phrase, else 0. Null and empty texts have no words. Null ids and repeated rows
    stay as they are; an empty table gives an empty result; other columns aren't read.
    """
    ordered = ordered if ordered is not None else rules()

    def work(batches):
        scanner = Scanner(ordered)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                n, base, found = scanner.scan(text)
                places = [w for w, _ in base]
                labels = {x for _, x in base}
                out.append((
                    n, len(base), min(places, default=None), max(places, default=None),
                    ",".join(sorted(labels)), ",".join(sorted(labels | {f[2] for f in found})),
                    max([f[3] for f in found] + [0.7] * bool(base), default=0.0),
                    ",".join(sorted({f[4] for f in found if f[4]})),
                    [{"first": a, "last": b, "label": x, "confidence": c, "version": v} for a, b, x, c, v in found],
                ))
            columns = list(zip(*out)) or [()] * 9
            kinds = [
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string(),
                pa.list_(pa.struct([
                    ("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("confidence", pa.float64()), ("version", pa.string()),
                ])),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "versions", "detections"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(
        work,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, versions string, "
        "detections array<struct<first: long, last: long, label: string, confidence: double, version: string>>",
    )
