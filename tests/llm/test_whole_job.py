"""Cases where an operator once did less than its whole job."""

import textwrap

import pytest

GRANT = '''Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.'''


def scanned(spark, texts):
    from screenlake.llm.licenses import scan_licenses

    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")).collect()
    return [r for _, r in sorted((r.doc_id, r) for r in got)]


@pytest.mark.parametrize("width", [30, 52, 66, 79, 2000])
def test_whole_license_texts_at_any_width(spark, width):
    from screenlake.llm.licenses import TEXTS

    names = ["MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0--terms", "MPL-2.0"]
    wrap = lambda t: "\n\n".join(textwrap.fill(p, width, break_on_hyphens=False, break_long_words=False) for p in t.split("\n\n"))
    bodies = [(TEXTS / f"{n}.txt").read_text() for n in names]
    texts = [f"Copyright (c) 2020 Some One\nAll rights reserved.\n\n{wrap(b)}\n" for b in bodies]
    # Its own copyright line, which names and years may stand in, cannot be told from text once it is wrapped.
    names, texts = [*names, "GPL-3.0"], [*texts, (TEXTS / "GPL-3.0.txt").read_text()]
    for name, got in zip((n.split("--")[0] for n in names), scanned(spark, texts)):
        assert (got.text_license, got.n_notices, got.notice_licenses) == (name, 1, name), (name, width, got)


def test_wrapped_notices_inside_a_text(spark):
    from screenlake.llm.licenses import TEXTS

    header = (TEXTS / "Apache-2.0--header.txt").read_text()
    code = "#!/bin/sh\n#\n# Copyright 2021 Acme\n#\n" + "".join(f"# {x}\n" for x in header.splitlines()) + "\necho hello\n"
    star = "/*\n" + "".join(f" * {x}\n" for x in textwrap.wrap(GRANT, 48)) + " */\nint x;\n"
    mpl = "// This Source Code Form is subject to the terms of the Mozilla Public License, v.\n// 2.0.\nfn main() {}"
    split = "prose\nReleased under the\nMIT License.\nReleased under the MIT License.\nprose License."
    part = "prose Released under the\nMIT License.\nReleased under\nthe MIT License for all.\n"
    a, b, c, d, e = scanned(spark, [code, star, mpl, split, part])
    assert (a.text_license, a.n_notices, a.notice_licenses) == (None, 1, "Apache-2.0")
    assert (b.n_notices, b.notice_licenses) == (1, "ISC")
    assert (c.n_notices, c.notice_licenses) == (1, "MPL-2.0")
    assert (d.n_notices, d.notice_licenses) == (2, "MIT")
    assert (e.n_notices, e.notice_licenses) == (0, "")


def test_context_is_taken_from_the_text_around_a_span(spark):
    from screenlake.llm.pii import find_personal_data

    gap = "x" * 41
    texts = [
        "ssn 123-45-6789, 123-45-6789", "123-45-6789 (SSN)", f"ssn {gap} 123-45-6789 {gap} ssn", "SSN\n" + "123-45-6789\n" * 3,
        "a@b.cc " * 300 + "a@b.cc mail", "123-45-6789 " + "9" * 27 + " ssn", "123-45-6789 " + "9" * 36 + " ssn",
    ]
    got = {r.doc_id: r.spans for r in find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")).collect()}
    at = [[(s.start, s.score) for s in got[i]] for i in range(len(texts))]
    assert at[0] == [(4, 0.8), (17, 0.8)] and at[1] == [(0, 0.8)] and at[2] == []
    assert [a for a, _ in at[3]] == [4, 16, 28]
    assert [x for _, x in at[4]] == [0.9] * 295 + [1.0] * 6 and [a for a, _ in at[4]] == list(range(0, 2107, 7))
    assert len(at[5]) == 1 and at[6] == []


def named(text):
    from screenlake.llm.secrets import spans_of

    return [text[a:b] for a, k, b in spans_of(text) if k == "named"]


def test_long_literals_key_blocks_and_urls_are_secrets():
    block = r"-----BEGIN PRIVATE KEY-----\nMIIEvQIBADANBg\n-----END PRIVATE KEY-----\n"
    assert named('{"type": "x", "private_key": "%s"}' % block) == [block]
    long = "aB3dE5fG7+" * 1000
    assert named(f'credentials = "{long}"') == [long]
    url = "postgres://joe:Sw0rdf1sh@db.example.com/x"
    assert named(f'dsn = "{url}"\nsecret = "https://u:{url[15:24]}@h/"') == [url, f"https://u:{url[15:24]}@h/"]
    assert named('passphrase = "correct horse battery staple"') == ["correct horse battery staple"]
    assert named('secret = "https://example.com/docs"\ndsn = "https://joe:${PASS}@h"\nauth_key = "-----BEGIN PUBLIC KEY-----"') == []


def test_constants_travel_any_way_to_a_sensitive_name():
    secret = "Zq81mmKq0s"
    chain = f'c0 = "{secret}"\n' + "".join(f"c{i} = c{i - 1}\n" for i in range(1, 40))
    assert named(chain + "auth_token = c39\n") == [secret]
    assert named("auth_token = c39\n" + "\n".join(chain.splitlines()[::-1])) == [secret]
    assert named(f'k = "{secret}"; auth_token = k; k = ""') == [secret]
    parts = [f"Ab{i}" for i in range(100)]
    assert named("auth_token = " + " + ".join(f'"{x}"' for x in parts)) == parts
    assert named(f'mixed = prefix() + "{secret}"\nother = prefix + "{secret}"\nauth_token = other') == [secret]
    assert named(f'a = b\nb = a + "{secret}"\nauth_token = a') == [secret]
    double = f'd0 = "{secret}"\n' + "".join(f"d{i} = d{i - 1} + d{i - 1}\n" for i in range(1, 60))
    assert named(double + "auth_token = d59") == [secret]
    assert named('a = "zX8-1"\nauth_token = a + a') == ["zX8-1"]


def test_table_of_licenses_gives_what_a_list_gives(spark):
    from screenlake.llm.licenses import known_texts, scan_licenses

    known = known_texts()
    longest = max((x for _, x in known), key=len)
    mit = next(x for k, x in known if k == "MIT" and len(x) > 500)
    wrapped = "\n".join("# " + x for x in mit.replace("\n\n", "\n").split("\n"))
    texts = [
        mit, f"before\n{wrapped}\nafter", f"{longest}\nReleased under the MIT License.", "Licensed under CC BY 4.0.\nx\nReleased under the ISC License.",
        None, "", "\n\n", "nothing here", "Licensed under the Apache License,\nVersion 2.0.", mit.upper(), mit[:-30],
    ]
    rows = list(enumerate(texts)) + [(None, mit), (0, mit), (None, None)] + [(100 + i, "Released under the MIT License.") for i in range(40)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id LONG, text STRING, license STRING, _key INT").repartition(5)
    table = spark.createDataFrame([*known, ("Z", None), ("Z", "")], "license STRING, text STRING")
    key = lambda r: tuple((x is not None, x) for x in r)
    by_list = sorted(map(tuple, scan_licenses(docs).collect()), key=key)
    got = scan_licenses(docs, table)
    assert got.columns == scan_licenses(docs).columns and sorted(map(tuple, got.collect()), key=key) == by_list
    found = {r[0]: r for r in by_list}
    assert found[0][2] == "MIT" and found[1][4] == "MIT" and found[1][3] == 1 and found[3][3] == 2 and found[7][3] == 0
    assert scan_licenses(docs.limit(0), table).collect() == []
    none = scan_licenses(docs, table.limit(0)).collect()
    assert len(none) == len(rows) and all(r.n_notices == 0 and r.text_license is None for r in none)
