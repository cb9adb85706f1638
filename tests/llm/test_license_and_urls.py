import pytest
from pyspark.sql import functions as F

from quarry.llm import license_sentences as ls
from quarry.llm import url_reputation as ur
from tests.llm.fixtures import awkward, empty


def test_long_licences_and_order(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in\nall copies or substantial portions of the Software."
    texts = {1: "Intro text.\n" + mit, 2: "no stop here\nLicensed under CC BY-NC 4.0.", 3: "Licensed under the Apache\nLicense, Version 2.0. Licensed under the Apache License, Version 2.0.", 4: "a license to kill.", 5: None, 6: "Released under the MIT License. Licensed under CC BY-SA 4.0."}
    got = {r.doc_id: r for r in ls.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got[1].licenses == ["MIT"] and got[1].sentence_ids == ["MITGrant", "MITNotice"]
    assert got[2].licenses == ["CC-BY-NC-4.0"]
    assert got[3].licenses == ["Apache-2.0"] and len(got[3].sentence_ids) == 2
    assert got[4].licenses == got[5].licenses == []
    assert got[6].licenses == ["MIT", "CC-BY-SA-4.0"]


def test_awkward_rows(spark):
    extra = awkward(spark).withColumn("text", F.when(F.col("doc_id") == 5, F.concat("text", F.lit(". Licensed under the MIT License."))).otherwise(F.col("text")))
    got = sorted(((r.doc_id, r.sentence_ids, r.licenses) for r in ls.scan(extra).collect()), key=repr)
    want = [(r.doc_id, ["MIT:name"] if r.doc_id == 5 else [], ["MIT"] if r.doc_id == 5 else []) for r in extra.collect()]
    assert got == sorted(want, key=repr)
    assert ls.scan(empty(spark)).count() == 0


def test_hosts_and_rules(spark):
    urls = ["https://A.Example.ORG/es/x?q#f", "http://b.com?x", "nothing", None, "x://h#/p", "http://example.org/en/12", "http://notexample.org/es/1", "http://a.fr.com/fr/"]
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumn("host", F.lit("clash"))
    none = spark.createDataFrame([], "url string, bad int")
    got = {r.page_id: r for r in ur.filter_urls(pages, none, rules).collect()}
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("b.com", "", None, "allow")
    assert [(got[i].host, got[i].path) for i in (2, 3, 4)] == [("", ""), ("", ""), ("h", "")]
    assert got[5].rule == "example.org/en/1" and got[6].rule == "org/" and got[7].rule == "com/fr/"


def test_reputation_shrinks(spark):
    rows = [("http://bad.x.com/", 1)] * 60 + [("http://bad.x.com/", 0)] * 2 + [("http://one.x.com/", 1)] + [("http://good.y.org/", 0)] * 80 + [("http://c.co.uk/", None)] * 3
    out = spark.createDataFrame(rows, "url string, bad int")
    found = ur.host_reputation(out.select(ur.url_host(F.col("url")).alias("host"), "bad"))
    rep = {r.host: r.rate for r in found.hosts.collect()}
    assert rep["bad.x.com"] > 0.8 > rep["good.y.org"] and rep["one.x.com"] < 1
    assert {r.domain for r in found.domains.collect()} == {"x.com", "y.org"} and found.corpus.count() == 1
    judged = ur.filter_urls(out.select(F.lit(1).alias("page_id"), "url").distinct(), out, [])
    got = {r.host: r.verdict for r in judged.collect()}
    assert got["bad.x.com"] == "block" and got["good.y.org"] == "allow" and got["c.co.uk"] == "allow"


def test_ports_users_and_dots_share_a_reputation(spark):
    rows = [("http://bad.x.com:8080/", 1)] * 30 + [("http://me@BAD.x.com/", 1)] * 30 + [("http://y.org/", 0)] * 60
    out = spark.createDataFrame(rows, "url string, bad int")
    pages = spark.createDataFrame([(1, "https://bad.x.com./a"), (2, "http://bad.x.com:99"), (3, "http://y.org:1/"), (3, "http://y.org:1/")], "page_id long, url string")
    got = sorted((r.page_id, r.host, r.verdict) for r in ur.filter_urls(pages, out, []).collect())
    assert got == [(1, "bad.x.com.", "block"), (2, "bad.x.com:99", "block"), (3, "y.org:1", "allow"), (3, "y.org:1", "allow")]
    assert ur.filter_urls(pages.limit(0), out, []).count() == 0
    assert {r.verdict for r in ur.filter_urls(pages, out.limit(0), []).collect()} == {"allow"}


def test_domains(spark):
    hosts = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("b.com",), ("com",), ("",), ("x.co.in",), ("a.x.gob.mx",), ("x.com.xyz",)], "h string")
    s = ur.host_suffix(F.col("h"))
    got = {r.h: (r.s, r.d) for r in hosts.select("h", s.alias("s"), ur.registered_domain(F.col("h"), s).alias("d")).collect()}
    assert got == {"a.b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"), "b.com": ("com", "b.com"), "com": ("com", "com"), "": ("", ""), "x.co.in": ("co.in", "x.co.in"), "a.x.gob.mx": ("gob.mx", "x.gob.mx"), "x.com.xyz": ("xyz", "com.xyz")}


MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n'
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n"
GPL = "This program is free software{} you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation{} either version {} of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\n"
APACHE = 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\n'
NOTICES = [
    ("MIT", MIT + '\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT'), ("MIT", MIT), ("MIT", "Released under the MIT License."),
    ("BSD-3-Clause", BSD + "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n"), ("BSD-2-Clause", BSD),
    ("Apache-2.0", APACHE + "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n"), ("Apache-2.0", APACHE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-or-later", GPL.format(":", ",", 3)), ("GPL-3.0-or-later", GPL.format(";", ";", 3)), ("GPL-2.0-or-later", GPL.format(";", ";", 2)), ("GPL-2.0-or-later", GPL.format(";", ",", 2)),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."), ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."), ("LGPL-3.0-only", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."), ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    *[(f"CC-{k}-4.0", f"Licensed under CC {k} 4.0.") for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA")],
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."), ("LicenseRef-all-rights-reserved", "All rights reserved."),
]


def test_every_licence_on_its_original_notice(spark):
    texts = [(i, t) for i, (_, t) in enumerate(NOTICES)]
    got = {r.doc_id: r.licenses for r in ls.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert {i: (n, got[i]) for i, (n, _) in enumerate(NOTICES)} == {i: (n, [n]) for i, (n, _) in enumerate(NOTICES)}
    assert {n for n, _ in NOTICES} | set(PUBLISHED) >= {n for n, _ in ls.RULES}


def test_every_name_and_a_way_to_say_it(spark):
    ways = ["Licensed under the {}.", "this project is released under {};\nmore", "The code is distributed under the terms of the {}:\n", "x. Made available under a {}! y"]
    texts = [(i, ways[i % len(ways)].format(name.upper() if i % 3 else name), key) for i, (name, key) in enumerate(ls.short_names().items())]
    got = {r.doc_id: r.licenses for r in ls.scan(spark.createDataFrame(texts, "doc_id long, text string, key string")).collect()}
    assert {i: got[i] for i, _, _ in texts} == {i: [key] for i, _, key in texts}
    assert len(texts) > 1000 and len(set(ls.short_names().values())) > 100


def test_tables_can_be_extended(spark):
    sentences, rules = ls.tables(spark)
    own = ls.Knowledge.load(sentences.unionByName(spark.createDataFrame([("You may copy this under the Teapot Terms", "Tea1"), ("Copyright stays warm", "Tea2")], "sentence string, id string")), rules.selectExpr("place + 1 AS place", "licence", "ids").unionByName(spark.createDataFrame([(0, "Teapot", ["Tea1", "Tea2"])], "place int, licence string, ids array<string>")))
    docs = spark.createDataFrame([(1, "You may copy this under the teapot terms.\nSomething else; copyright stays warm. Licensed under CC BY 4.0."), (2, "Copyright stays warm. You may copy this under the Teapot terms.")], "doc_id long, text string")
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in ls.scan(docs, known=own).collect()}
    assert got == {1: (["Tea1", "Tea2", "CC-BY-4.0:name"], ["Teapot", "CC-BY-4.0"]), 2: (["Tea2", "Tea1"], [])}
    with pytest.raises(ValueError, match="more than 5"):
        ls.Knowledge.load(sentences, rules, most_entries=5)


def test_an_unseen_host_has_its_domains_reputation(spark):
    """A third of the outcomes are one domain's, all of them bad."""
    rows = [(f"http://h{i}.spam.com/{k}", 1) for i in range(29) for k in range(20)] + [(f"http://g{i}.good{i % 7}.{t}/{k}", 0) for i in range(29) for k in range(20) for t in ("com", "org")]
    out = spark.createDataFrame(rows, "url string, bad int")
    pages = spark.createDataFrame([(1, "http://new.spam.com/"), (2, "http://spam.com/"), (3, "http://new.good1.com/"), (4, "http://unknown.com/"), (5, "http://a.b.nowhere/"), (6, None)], "page_id long, url string")
    got = {r.page_id: r for r in ur.filter_urls(pages, out, []).collect()}
    assert [got[k].verdict for k in range(1, 7)] == ["block", "block", "allow", "allow", "allow", "allow"]
    assert got[1].bad_bound > 0.8 and all(r.bad_bound is not None for r in got.values())
    assert got[4].bad_bound > got[5].bad_bound or got[4].bad_bound < 0.2


#: Notices as they are published, and what they are.
PUBLISHED = {
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
   * Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
   * Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
   * Neither the name of {holder} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy it.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "GPL-3.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 3 of the License.",
    "Apache-2.0": "\n                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n",
    "MPL-2.0": "// SPDX-License-Identifier: MPL-2.0\nint main() {}",
    "GPL-2.0-or-later": "/* SPDX-License-Identifier: GPL-2.0-or-later */",
}


def test_published_notices(spark):
    rows = [(name, text.replace("{holder}", holder)) for name, text in PUBLISHED.items() for holder in ("Google Inc.", "the Example Project", "the copyright holder", "Acme, Ltd. and Sons")]
    got = ls.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {(r.doc_id, tuple(r.licenses)) for r in got} == {(name, (name,)) for name in PUBLISHED}
