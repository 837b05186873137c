import hashlib
import random
import re
import string

import pytest

from clickledger.llm import personal_data, secret_scan
from clickledger.llm.queries import op2_secret_scan, op6_personal_data

from .conftest import FOLDER

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)).encode()).hexdigest()


def plain_secrets(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return spans + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def plain_personal(text):
    spans = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            spans.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(x) for x in m[0] if x.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(d[::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0:
            spans.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append((m.start(), 3, m.end(), "phone"))
    return spans


@pytest.mark.parametrize(
    "query,plain,kinds",
    [
        (op2_secret_scan, plain_secrets, ["assign", "access", "hex"]),
        (op6_personal_data, plain_personal, ["email", "ip", "card", "phone"]),
    ],
)
def test_base_spans_of_all_documents(spark, documents, query, plain, kinds):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    got = query(spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(spans)
        assert [r[f"n_{k}"] for k in kinds] == [sum(s[3] == k for s in spans) for k in kinds]
        assert {f"{k}:{s}:{e}" for s, _, e, k in spans} <= set(r["spans"].split(","))


def test_forms_agree_on_made_up_text():
    draw = random.Random(5)
    parts = ["a@b.c", "@", "x.y", "1.2.3.4", "256", "0255.1.1.1.9", "+49 (30) 123-456 78", "4111 1111 1111 1111", ".", "-", " ",
             "token=abcdef", "Passwd: 'x1y2z3'", "api_key", "= ", "AKIA", "QWERTYUIOP123456", "deadbeef", "0123456789abcdef", "ſecret=abcdefg", "9"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(1, 12)))
        mine = [(s, k, e, personal_data.KINDS[k]) for s, k, e in personal_data.detect(text)]
        assert sorted(mine) == sorted(plain_personal(text)), text
        found = [x for x in secret_scan.scan_text(text, secret_scan.Levels()) if x[3] != "random"]
        assert found == sorted(plain_secrets(text)), text


def test_random_strings_are_told_from_writing():
    draw, levels = random.Random(2), secret_scan.Levels()
    letters = string.ascii_letters + string.digits
    hits = sum(bool(secret_scan.random_spans("".join(draw.choices(letters, k=40)), levels)) for _ in range(300))
    assert hits > 280
    for plain in ["my_long_variable_name_v2_final", "AbstractSingletonProxyFactoryBean2", "2024-01-01-release-notes",
                  "1234567890123456789012", "internationalization", "aaaaaaaaaaaa11111111111", "getUserProfileById2"]:
        assert secret_scan.random_spans(f"see {plain} there", levels) == []


def test_tests_of_the_battery_hold_their_level():
    draw = random.Random(4)
    for size, n in ((16, 40), (62, 64)):
        runs = [[draw.randrange(size) for _ in range(n)] for _ in range(2000)]
        for test in (lambda x: secret_scan.chi_squared_p(x, size), lambda x: secret_scan.runs_p(x, size), secret_scan.serial_p):
            assert sum(test(x) < 0.05 for x in runs) < 0.075 * len(runs)


@pytest.mark.parametrize(
    "text,kind,source",
    [
        ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
        ("write to jane at example dot com please", "email", "jane at example dot com"),
        ("für bоb@exаmple.com hier", "email", "bоb@exаmple.com"),
        ("call plus four nine three zero one two three four five six", "phone", "plus four nine three zero one two three four five six"),
        ("host 192 dot 168 dot 1 dot 10 up", "ip", "192 dot 168 dot 1 dot 10"),
        ("card ４１１１ １１１１ １１１１ １１１１ ok", "card", "４１１１ １１１１ １１１１ １１１１"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, source):
    _, hidden = personal_data.scan_text(text)
    assert [(personal_data.KINDS[k], text[s:e]) for s, k, e in hidden] == [(kind, source)]


def test_plain_writing_has_no_disguise():
    for text in ["He sat at home. The dot com era began at once.", "one two three and four", "Un deux, la maison [at home]", "a.b at c"]:
        assert personal_data.scan_text(text) == ([], [])


def test_awkward_rows(awkward, nothing):
    got = personal_data.find_personal_data(awkward, mask=True)
    assert got.count() == awkward.count() and got.filter("size(found) > 0").count() == 0
    assert got.filter("doc_id = 2").first()["masked"] is None
    assert secret_scan.find_secrets(awkward).count() == awkward.count()
    assert personal_data.find_personal_data(nothing).count() == secret_scan.find_secrets(nothing).count() == 0


def test_long_runs_take_linear_time():
    for text in ["a" * 300_000 + "@", "9" * 300_000, "1." * 100_000, "+1" + " " * 200_000, "0-" * 100_000]:
        personal_data.scan_text(text)
        secret_scan.scan_text(text, secret_scan.Levels())


def test_random_strings_of_small_alphabets_and_long_documents():
    draw, levels, alphabets = random.Random(7), secret_scan.Levels(), dict(secret_scan.ALPHABETS)

    def secret(name, n):
        while True:
            text = "".join(draw.choices(alphabets[name], k=n))
            if any(c.isdigit() for c in text) and any(c.isalpha() for c in text):
                return text

    for name, n, most in (("base32", 16, 0.5), ("base32", 32, 0.15), ("base36", 20, 0.2), ("base62", 20, 0.12), ("base64url", 40, 0.06)):
        missed = sum(not secret_scan.random_spans(secret(name, n), levels) for _ in range(300))
        assert missed <= most * 300, (name, n, missed)
    plain = [f"{a}_{b}_version_{k}" for k, (a, b) in enumerate([("window", "summary"), ("customer", "address"), ("release", "notes")] * 60)]
    secrets = [secret("base62", 40) for _ in range(5)]
    text = " ".join([*plain, *secrets])
    assert {text[s:e] for s, e in secret_scan.random_spans(text, levels)} == set(secrets)


def test_strings_the_battery_rejects_are_not_in_the_family():
    draw, levels = random.Random(8), secret_scan.Levels()
    found = "".join(draw.choices(string.ascii_letters + string.digits, k=24))
    rejected = [f"{'a' * 30}{k}" for k in range(400)]
    assert not any(secret_scan.looks_random(x, levels.random) for x in rejected)
    text = " ".join([*rejected, found])
    assert [text[s:e] for s, e in secret_scan.random_spans(text, levels)] == [found]


@pytest.mark.parametrize(
    "text,kind,source",
    [
        ("or jane @ example . com please", "email", "jane @ example . com"),
        ("please mail jane at example.com today", "email", "jane at example.com"),
        ("call +1 four one five 555 0199 now", "phone", "+1 four one five 555 0199"),
        ("so a dot b dot c at host dot com there", "email", "a dot b dot c at host dot com"),
    ],
)
def test_partly_plain_disguises(text, kind, source):
    _, hidden = personal_data.scan_text(text)
    assert [(personal_data.KINDS[k], text[s:e]) for s, k, e in hidden] == [(kind, source)]


def test_plain_writing_near_the_new_forms():
    for text in ["look at example.com today", "mail me at example.com", "we met @ home. then left", "one two three 1999 or so"]:
        assert personal_data.scan_text(text) == ([], [])
