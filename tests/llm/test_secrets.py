import base64
import hashlib
import random
import re
import string

from barlake.llm import secrets

SF = "/root/testdata/sf0.001"
KINDS = ("assign", "access", "hex")


def base(text):
    """The patterns read literally: match first, drop failing matches after."""
    out = []
    word = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    for m in re.finditer(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, r"AKIA[A-Z0-9]+", 20), (2, r"[0-9a-f]+", 24)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(out)]


def check(rows, out):
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        spans = base(text or "")
        for r in by[i]:
            assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in spans) for k in KINDS)
            assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
            assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == spans


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, secrets.op8_secrets(spark, SF).collect())


def test_odd_texts(spark, made):
    texts = [
        None, "", "PassWord='abc' token:secret=abcdef secret=token:abcdef", "api_key = x1y2z3, ApiKey:\"q.w-e+r/t=\"", "AKIA" + "A" * 15,
        "xAKIA" + "AKIA" * 4, "deadbeef" * 3, "deadbeef" * 2 + "g" + "0" * 24, "ſecret=abcdef toKen=abcdef", "é😀 token=" + "a" * 9000,
        "password  :=  abcdefg", "secret\n=abcdef", "0" * 60000 + " passwd=1234567",
    ]
    rows = list(enumerate(texts))
    at = made("documents", [(*r, 3, "s") for r in rows + rows[2:3]], "doc_id long, text string, n_hex int, spans string")
    out = secrets.op8_secrets(spark, at).collect()
    assert len(out) == len(rows) + 1
    check(rows, [r for k, r in enumerate(sorted(out, key=lambda r: r.doc_id)) if k != 3])


def test_random_strings_are_found_and_words_are_not():
    path = secrets.vocabulary_path()
    found = lambda t: [t[s:e] for k, s, e in secrets.find(t, path)[1] if k == "random"]
    key = "xK9fQ2mZ7pLw4RtY8vBn3HsD"
    assert found(f"use {key} here") == [key]
    for clean in (
        "internationalization-of-things-2024-report", "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822c",
        "550e8400-e29b-41d4-a716-446655440000", "12345678901234567890123", "thntionthereonstionandthing", "D41D8CD98F00B204E9800998ECF8427E",
    ):
        assert found(f"see {clean}.") == []


def test_empty_table(spark, made):
    at = made("documents", [], "doc_id long, text string")
    assert secrets.op8_secrets(spark, at).collect() == []


def test_redaction_masks_and_keeps_rows_and_columns(spark):
    rows = [(1, "a password=abcdef1 b", "en", 5, "k"), (2, None, None, None, "k"), (3, "clean", "de", 5, None), (1, "é token: 0123456789abcdef0123456789", "x", 0, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, found string")
    out = sorted((tuple(r) for r in secrets.redact(docs).collect()), key=repr)
    assert out == sorted([(1, "a [SECRET] b", "en", 12, "k"), rows[1], rows[2], (1, "é [SECRET]", "x", 10, "k")], key=repr)


def test_keys_are_found_beside_words_short_or_without_digits():
    path, rng = secrets.vocabulary_path(), random.Random(5)
    letters = string.ascii_letters
    prefixes = (
        "https://api.example.com/users/profile/settings/download/", "/home/ubuntu/projects/application/configuration/credentials/",
        "session-management-authentication-cookie=", "access_key_identifier=", "0123456789abcdef0123456789abcdef/", "",
    )

    def share(make, prefix):
        texts = [(prefix, make()) for _ in range(200)]
        hit = 0
        for before, key in texts:
            spans = secrets.find(f"see {before}{key} here", path)[1]
            start = 4 + len(before)
            hit += any(k == "random" and s <= start + 4 and e >= start + len(key) - 4 for k, s, e in spans)
        return hit / len(texts)

    for prefix in prefixes:
        assert share(lambda: "".join(rng.choices(letters + string.digits, k=24)), prefix) > 0.97
        assert share(lambda: "".join(rng.choices(letters + string.digits, k=16)), prefix) > 0.93
        assert share(lambda: "".join(rng.choices(letters, k=24)), prefix) > 0.93
        assert share(lambda: base64.b64encode(rng.randbytes(30)).decode(), prefix) > 0.9


def test_paths_names_and_known_forms_are_not_random():
    path = secrets.vocabulary_path()
    for clean in (
        "/users/550e8400-e29b-41d4-a716-446655440000/profile", "org/apache/hadoop/hdfs/DFSClient", "AbstractSingletonProxyFactoryBean",
        "backup-20240105T101530Z", "commit/9f86d081884c", "0x7ffeefbff5c8", "a/b/c/d/e/f/g/h/i/j/k/l",
        "objects/D41D8CD98F00B204E9800998ECF8427E/data", "Donaudampfschifffahrtsgesellschaft",
    ):
        assert [s for s in secrets.find(f"see {clean} now", path)[1] if s[0] == "random"] == [], clean


def test_known_names_are_no_secrets():
    clean = [
        "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "sha512-z4PhNX7vuL3xVChQ1m2AB9Yg5AULVxXcg/SpIdNs6c5H0NE8XYXysP+DGNKHfuwvY7kxvUdBeoGlODJ6+SfaPg==",
        "/wiki/ISBN_978-3-16-148410-0", "IMG_20240105_123456_HDR", "ISO-8859-15/UTF-16LE/CP1252", "1st-2nd-3rd-4th-5th-6th",
        "https://example.org/books/ISBN-0-306-40615-2/cover", "windows-1252/iso-8859-1", "VID_20231224_1805_final",
    ]
    for text in clean:
        assert secrets.find(f"see {text} here", secrets.vocabulary_path())[1] == [], text
    key = "q8Zr4LwX0vTn2KdJ7sBf"
    for text in (f"ISO-8859-15/{key}", f"IMG_20240105_123456_{key}", f"1st-{key}"):
        spans = secrets.find(text, secrets.vocabulary_path())[1]
        at = text.index(key)
        assert any(s <= at and e >= at + len(key) for _, s, e in spans), text
