"""Licence recognition by sentences: known sentences give identifiers, ordered
rules over the sequence of identifiers give licences.

A text is cut into sentences, each is normalised (A-Z lower-cased, all but
letters, digits and inner dots turned into single spaces, ways to say "this work is licensed under the"
all turned into "under") and looked up among the known sentences.  What remains is a short sequence of identifiers.  The
rules are tried in order on that sequence; a rule matches where its identifiers
stand next to each other, and the identifiers it used are spent, so a long
licence isn't also reported as the shorter ones it contains.

Sentences and rules are tables, (sentence, id) and (place, licence, ids): :func:`sentence_table` and
:func:`rule_table` make those known here, and :class:`Knowledge` takes any others of at most
``most_entries`` rows.  They go to the tasks as constants, sentences dealt into buckets by their hash, so a
look-up costs the same however many there are.  All of it is DataFrame expressions in one pass without a
shuffle.

Defined results: null and empty texts have no sentence and no licence; the same
licence twice is reported once; sentences nobody knows don't count, so identifiers next to
them are next to each other; repeated rows are judged one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cache

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower

# Sentences of public licences and notices in their normal form.
SENTENCES: dict[str, str] = {
    "licensed under the apache license version 2.0 the license": "ApacheGrant",
    "you may not use this file except in compliance with the license": "ApacheCompliance",
    "you may obtain a copy of the license at": "ApacheCopy",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITWarranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDNames",
    "neither the name of the organization nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDNames",
    "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDNames",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3PlusGrant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2PlusGrant",
    # The notices as written have ':' or ';' after "free software" and often ';' after "foundation".
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3PlusGrant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2PlusGrant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "GPLTerms",
    "either version 3 of the license or at your option any later version": "Version3Later",
    "either version 2 of the license or at your option any later version": "Version2Later",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "MPL2Grant",
    "this source code form is subject to the terms of the mozilla public license v": "MPL2Grant",  # cut after "v."; no other version says so
    "all rights reserved": "AllRights",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0BSDGrant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "ISCWarranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZlibGrant",
    "the origin of this software must not be misrepresented you must not claim that you wrote the original software": "ZlibOrigin",
    "this is free and unencumbered software released into the public domain": "UnlicenseGrant",
    "apache license version 2.0 january 2004 http www.apache.org licenses": "ApacheText",
    "version 2 of the license": "Version2Only",
    "version 3 of the license": "Version3Only",
}

# Licences of the Free Software Foundation by name and the versions that their notices speak of.
NOTICES = (("GPL", "gnu general public license", ("2", "3")), ("LGPL", "gnu lesser general public license", ("2.1", "3")), ("LGPL", "gnu library general public license", ("2",)), ("AGPL", "gnu affero general public license", ("3",)))


def notices() -> tuple[dict[str, str], list[tuple[str, tuple[str, ...]]]]:
    """Sentences and rules of those notices, whole or cut at their semicolons, "or later" or not."""
    said, rules = {}, []
    for key, name, versions in NOTICES:
        terms = f"you can redistribute it and or modify it under the terms of the {name}"
        said[f"{terms} as published by the free software foundation"] = f"{key}Terms"
        for v in versions:
            full, later, only = f"{key}-{v if '.' in v else v + '.0'}", f"either version {v} of the license or at your option any later version", f"version {v} of the license"
            said |= {later: f"Version{v.replace('.', '')}Later", only: f"Version{v.replace('.', '')}Only"}
            for begin in ("", "this program is free software ", "this library is free software "):
                said[f"{begin}{terms} as published by the free software foundation {later}"] = f"{key}{v}PlusGrant"
                said[f"{begin}{terms} as published by the free software foundation {only}"] = f"{key}{v}Grant"
                said[f"{begin}{terms} version {v} as published by the free software foundation"] = f"{key}{v}Grant"
            rules += [(f"{full}-or-later", (f"{key}{v}PlusGrant",)), (f"{full}-or-later", (f"{key}Terms", f"Version{v.replace('.', '')}Later"))]
            rules += [(f"{full}-only", (f"{key}{v}Grant",)), (f"{full}-only", (f"{key}Terms", f"Version{v.replace('.', '')}Only"))]
    return said, rules


# Licence and the identifiers that stand for it, in the order tried.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("MITGrant", "MITNotice", "MITWarranty")),
    ("MIT", ("MITGrant", "MITNotice")),
    ("BSD-3-Clause", ("BSDGrant", "BSDSource", "BSDBinary", "BSDNames")),
    ("BSD-2-Clause", ("BSDGrant", "BSDSource", "BSDBinary")),
    ("Apache-2.0", ("ApacheGrant", "ApacheCompliance", "ApacheCopy")),
    ("Apache-2.0", ("ApacheGrant", "ApacheCompliance")),
    ("GPL-3.0-or-later", ("GPL3PlusGrant",)),
    ("GPL-2.0-or-later", ("GPL2PlusGrant",)),
    ("GPL-3.0-or-later", ("GPLTerms", "Version3Later")),
    ("GPL-2.0-or-later", ("GPLTerms", "Version2Later")),
    ("Apache-2.0", ("ApacheText",)),
    ("ISC", ("ISCGrant", "ISCWarranty")),
    ("ISC", ("ISCGrant",)),
    ("0BSD", ("0BSDGrant", "ISCWarranty")),
    ("Zlib", ("ZlibGrant", "ZlibOrigin")),
    ("Zlib", ("ZlibGrant",)),
    ("Unlicense", ("UnlicenseGrant",)),
    ("MPL-2.0", ("MPL2Grant",)),
    ("LicenseRef-all-rights-reserved", ("AllRights",)),
]

# Public licences with versions, (identifier, names, versions, whether "or later" is a licence of its own).
FAMILIES = (
    ("GPL", ("gnu general public license", "gnu gpl", "gpl"), ("1.0", "2.0", "3.0"), True),
    ("LGPL", ("gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"), ("2.0", "2.1", "3.0"), True),
    ("AGPL", ("gnu affero general public license", "gnu agpl", "agpl"), ("3.0",), True),
    ("GFDL", ("gnu free documentation license", "gnu fdl", "gfdl"), ("1.1", "1.2", "1.3"), True),
    ("Apache", ("apache license", "apache software license"), ("1.0", "1.1", "2.0"), False),
    ("MPL", ("mozilla public license", "mpl"), ("1.0", "1.1", "2.0"), False),
    ("EPL", ("eclipse public license", "epl"), ("1.0", "2.0"), False),
    ("EUPL", ("european union public license", "eupl"), ("1.0", "1.1", "1.2"), False),
    ("CDDL", ("common development and distribution license", "cddl"), ("1.0", "1.1"), False),
    ("OSL", ("open software license", "osl"), ("1.0", "2.0", "2.1", "3.0"), False),
    ("AFL", ("academic free license", "afl"), ("1.1", "1.2", "2.0", "2.1", "3.0"), False),
    ("Artistic", ("artistic license",), ("1.0", "2.0"), False),
    ("CPL", ("common public license",), ("1.0",), False),
    ("ECL", ("educational community license",), ("1.0", "2.0"), False),
    ("OFL", ("sil open font license", "open font license"), ("1.0", "1.1"), False),
    ("BSL", ("boost software license",), ("1.0",), False),
    ("PHP", ("php license",), ("3.0", "3.01"), False),
    ("LPPL", ("latex project public license", "lppl"), ("1.0", "1.1", "1.2", "1.3c"), False),
    ("CECILL", ("cecill free software license agreement", "cecill license", "cecill"), ("1.0", "2.0", "2.1"), False),
    ("UPL", ("universal permissive license",), ("1.0",), False),
    ("ODbL", ("open database license", "odbl"), ("1.0",), False),
    ("ODC-By", ("open data commons attribution license",), ("1.0",), False),
    ("PDDL", ("open data commons public domain dedication and license",), ("1.0",), False),
    ("QPL", ("q public license",), ("1.0",), False),
)

# Public licences without versions and their names.
SINGLES = {
    "MIT": ("mit license", "expat license"), "ISC": ("isc license",), "Zlib": ("zlib license",), "Unlicense": ("unlicense",), "WTFPL": ("wtfpl",), "0BSD": ("bsd zero clause license",),
    "BSD-2-Clause": ("bsd 2 clause license", "simplified bsd license", "freebsd license"), "BSD-3-Clause": ("bsd 3 clause license", "new bsd license", "modified bsd license", "revised bsd license"),
    "BSD-4-Clause": ("bsd 4 clause license", "original bsd license"), "CC0-1.0": ("cc0", "cc0 1.0", "cc0 1.0 universal", "cc0 1.0 universal license", "creative commons zero license"),
    "PostgreSQL": ("postgresql license",), "NCSA": ("university of illinois ncsa open source license",), "MS-PL": ("microsoft public license",), "MS-RL": ("microsoft reciprocal license",),
    "Vim": ("vim license",), "X11": ("x11 license",), "Ruby": ("ruby license",), "Python-2.0": ("python license",), "PSF-2.0": ("python software foundation license",), "OpenSSL": ("openssl license",),
    "JSON": ("json license",), "W3C": ("w3c software license",), "Sleepycat": ("sleepycat license",), "Libpng": ("libpng license",), "Beerware": ("beerware license",), "curl": ("curl license",),
}

# Words of the Creative Commons licences, their versions and the scopes these name.
CC_PARTS = {"BY": "attribution", "SA": "sharealike", "NC": "noncommercial", "ND": "noderivatives"}
CC_KINDS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_SCOPES = ("", " international", " unported", " generic")


@cache
def short_names() -> dict[str, str]:
    """Licence by each name it may have after "licensed under the", built from the tables above."""
    out = {name: key for key, names in SINGLES.items() for name in names}
    for key, names, versions, later in FAMILIES:
        for name in names:
            for v in versions:
                for said in dict.fromkeys((v, v.removesuffix(".0"))):
                    for form in (f"{name} version {said}", f"{name} v{said}", f"{name} v {said}", f"{name} {said}", f"{name}v{said}"):
                        out[form] = f"{key}-{v}" + "-only" * later
                        if later:
                            out |= {f"{form} {tail}": f"{key}-{v}-or-later" for tail in ("or later", "or any later version", "or at your option any later version")}
    for kind in CC_KINDS:
        words = " ".join(CC_PARTS[p] for p in kind.split("-"))
        for v in CC_VERSIONS:
            for name in (f"cc {kind.lower().replace('-', ' ')} {v}", f"creative commons {words} {v}"):
                for scope in CC_SCOPES:
                    out |= {f"{name}{scope}{tail}": f"CC-{kind}-{v}" for tail in ("", " license")}
    return out | {name.replace("license", "licence"): key for name, key in out.items()}


# How a text says under what it stands.
SUBJECT = "(?:(?:this|the|our) [a-z]+ (?:is|are) )?"
SAYS = "(?:dual )?(?:licensed|licenced|released|distributed|published|available|made available)"
UNDER = f"^{SUBJECT}{SAYS} under (?:the terms of )?(?:the |a |an )?"


# The clause about names, whoever the holder is, and how it is known; what stands before a licence's tag.
HOLDER = "^(?:.+ )?nor the names of (?:its|their|the) contributors may be used"  # a holder with a full stop has cut the clause
NAMES = "neither the name of the copyright holder nor the names of its contributors may be used"
TAG = "spdx-license-identifier:[ \\t]*"


def licences() -> list[str]:
    """All licences known by a name or a text."""
    return list(dict.fromkeys([*short_names().values(), *(name for name, _ in [*RULES, *notices()[1]] if not name.startswith("LicenseRef"))]))


def sentence_table() -> list[tuple[str, str]]:
    """(sentence in normal form, identifier), all that are known here."""
    named = {f"under {name}": f"{key}:name" for name, key in short_names().items()}
    tagged = {normal_text(f"spdx license identifier {key}"): f"{key}:name" for key in licences()}
    return list(({normal_text(s): i for s, i in (notices()[0] | SENTENCES).items()} | named | tagged).items())


def rule_table() -> list[tuple[int, str, list[str]]]:
    """(place, licence, identifiers next to each other), in the order tried: texts first, names after them."""
    rules = [(name, list(ids)) for name, ids in [*RULES, *notices()[1]]] + [(key, [f"{key}:name"]) for key in licences()]
    return [(k, name, ids) for k, (name, ids) in enumerate(rules)]


def normal_text(sentence: str) -> str:
    """:func:`normal` for a sentence of a table."""
    bare = re.sub("[^a-z0-9.]+", " ", sentence.lower()) + " "
    return re.sub(HOLDER, NAMES, re.sub(UNDER, "under ", re.sub(r"\.+ ", " ", bare).strip()))


@dataclass(frozen=True)
class Knowledge:
    """Sentences and rules as constants; ``buckets`` of sentences by hash."""

    sentences: tuple[tuple[str, str], ...]
    rules: tuple[tuple[str, tuple[str, ...]], ...]
    buckets: int = 1024

    @staticmethod
    def of(sentences: Iterable[tuple[str, str]], rules: Iterable[tuple[int, str, Sequence[str]]], most_entries: int = 100_000) -> Knowledge:
        held = tuple((normal_text(s), i) for s, i in sentences)
        ordered = tuple((name, tuple(ids)) for _, name, ids in sorted(rules, key=lambda r: r[0]))
        if len(held) + len(ordered) > most_entries:
            raise ValueError(f"more than {most_entries} sentences and rules")
        for s, _ in held:
            if not any(a in s for a in ANCHORS):
                raise ValueError(f"no anchor in the known sentence {s!r}")
        return Knowledge(held, ordered)

    @staticmethod
    def load(sentences: DataFrame, rules: DataFrame, most_entries: int = 100_000) -> Knowledge:
        """From tables (sentence, id) and (place, licence, ids); more than ``most_entries`` rows raise."""
        rows = lambda df, *c: [tuple(r) for r in df.select(*c).limit(most_entries + 1).collect()]  # noqa: E731  bounded
        return Knowledge.of(rows(sentences, "sentence", "id"), rows(rules, "place", "licence", "ids"), most_entries)

    def table(self) -> Column:
        """Bucket by bucket, a constant map from sentence to identifier."""
        dealt: list[dict[str, str]] = [{} for _ in range(self.buckets)]
        for sentence, key in self.sentences:
            signed = xxhash.xxh64_intdigest(sentence.encode(), 42)
            dealt[(signed - (signed >> 63 << 64)) % self.buckets][sentence] = key
        return F.from_json(F.lit(json.dumps(dealt)), "array<map<string,string>>")

    def patterns(self) -> Column:
        """The rules in order: (licence, its identifiers as they stand in a sequence)."""
        return F.from_json(F.lit(json.dumps([{"name": n, "seen": "".join(f"|{i}|" for i in ids)} for n, ids in self.rules])), "array<struct<name:string,seen:string>>")


@cache
def known_here() -> Knowledge:
    return Knowledge.of(sentence_table(), rule_table())


def tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The sentences and rules known here as tables, to be extended and loaded again."""
    return spark.createDataFrame(sentence_table(), "sentence string, id string"), spark.createDataFrame(rule_table(), "place int, licence string, ids array<string>")


#: Each known sentence holds one of these, so a text without any has no match.
ANCHORS = ("licen", "copyright", "permission", "redistribut", "rights reserved", "warrant", "under", "public domain", "software")

SPACES = "[ \\t\\r\\n\\f\\x0B]"
_END = "\u0001"


def sentences(text: Column) -> Column:
    """Sentences in order: cut after . ! ? : ; before white space, and at blank
    lines; a sentence over several lines is followed by its single lines, since a
    notice may stand on a line of its own below a line without a full stop."""
    marked = F.regexp_replace(text, f"([.!?:;]){SPACES}+", f"$1{_END}")
    marked = F.regexp_replace(marked, f"\\n{SPACES}*\\n", _END)
    parts = F.split(marked, _END)
    return F.flatten(F.transform(parts, lambda s: F.when(s.contains("\n"), F.concat(F.array(s), F.split(s, "\n"))).otherwise(F.array(s))))


def normal(sentence: Column) -> Column:
    bare = F.regexp_replace(ascii_lower(sentence), "[^a-z0-9.]+", " ")
    bare = F.trim(F.regexp_replace(F.concat(bare, F.lit(" ")), "\\.+ ", " "))
    said = F.when(bare.contains("under "), F.regexp_replace(bare, UNDER, "under ")).otherwise(bare)
    return F.when(said.contains("nor the names of "), F.regexp_replace(said, HOLDER, NAMES)).otherwise(said)


def sentence_ids(text: Column, known: Knowledge | None = None) -> Column:
    """Array of the identifiers of the known sentences of ``text``, in order."""
    known = known or known_here()
    low = ascii_lower(F.coalesce(text, F.lit("")))
    # An anchor of two words may be broken by a line end; its first word can't.
    hit = F.lit(False)
    for a in ANCHORS:
        hit = hit | low.contains(a.split(" ")[0])
    low = F.when(low.contains("spdx"), F.regexp_replace(low, TAG, "spdx-license-identifier ")).otherwise(low)  # a tag is one sentence
    names = known.table()
    look_up = lambda s: F.try_element_at(F.get(names, F.pmod(F.xxhash64(s), F.lit(known.buckets)).cast("int")), s)
    ids = F.filter(F.transform(F.transform(sentences(low), normal), look_up), lambda x: x.isNotNull())
    return F.when(hit, ids).otherwise(F.array().cast("array<string>"))


def match_rules(ids: Column, known: Knowledge | None = None) -> Column:
    """Array of distinct licences, in the order of the rules, for an id sequence."""
    start = F.struct(F.concat(F.lit("|"), F.array_join(ids, "||"), F.lit("|")).alias("rest"), F.array().cast("array<string>").alias("found"))

    def apply(done: Column, rule: Column) -> Column:
        found = F.concat(done["found"], F.array(rule["name"]))
        return F.when(done["rest"].contains(rule["seen"]), F.struct(F.replace(done["rest"], rule["seen"], F.lit("#")).alias("rest"), found.alias("found"))).otherwise(done)

    return F.array_distinct(F.aggregate((known or known_here()).patterns(), start, apply)["found"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: Knowledge | None = None) -> DataFrame:
    """(id, sentence_ids array, licenses array) for each row of ``docs``."""
    found = docs.select(F.col(id_col), sentence_ids(F.col(text_col), known).alias("sentence_ids"))
    licenses = F.when(F.size("sentence_ids") > 0, match_rules(F.col("sentence_ids"), known)).otherwise(F.array().cast("array<string>"))
    return found.select(id_col, "sentence_ids", licenses.alias("licenses"))
