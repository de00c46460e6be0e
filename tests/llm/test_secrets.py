"""Secrets in many forms, what is none, and base spans against a scanner that uses no patterns."""

import random
import string

import pytest

from granary.llm import secret_scan

LETTERS, DIGITS = string.ascii_letters, string.digits
PROSE = "When a request arrives, the handler checks the session and returns the result to the caller, or a message if something went wrong. " * 3
FORMS = {
    "letters behind bearer": ("Authorization: Bearer ", LETTERS, 32, ""),
    "one case behind a word": ("private key ", string.ascii_lowercase, 24, ""),
    "many signs, assigned": ("pwd = ", LETTERS + DIGITS + "!@#$%^&*()-_=+[]{};:,.<>?/|~", 14, "\n"),
    "password of a URL": ("credential https://bob:", LETTERS + DIGITS, 16, "@db.example.com/x"),
    "URL without a sensitive word": ("see postgres://bob:", LETTERS + DIGITS + "!$%", 16, "@db.example.com:5432/x"),
    "key": ("key: ", LETTERS + DIGITS + "+/", 32, ""),
    "auth_key": ("auth_key = ", LETTERS + DIGITS, 32, ""),
    "quoted auth": ('"auth": "', LETTERS + DIGITS, 24, '"'),
    "digits": ("secret ", DIGITS, 20, ""),
    "short and mixed": ("password ", LETTERS + DIGITS, 10, ""),
}


@pytest.mark.parametrize("form", FORMS)
def test_recall(form):
    before, letters, n, behind = FORMS[form]
    rng, hits = random.Random(form), 0
    for _ in range(200):
        key = "".join(rng.choice(letters) for _ in range(n))
        text, at = f"{PROSE}{before}{key}{behind} {PROSE}", len(PROSE) + len(before)
        hits += any(s <= at and at + n <= e for _, s, e in secret_scan.find(text))
    assert hits >= 180


def test_signed_tokens():
    rng = random.Random(1)
    part = lambda n: "".join(rng.choice(LETTERS + DIGITS + "-_") for _ in range(n))
    for _ in range(50):
        token = f"eyJ{part(33)}.eyJ{part(60)}.{part(43)}"
        assert [PROSE.__len__() + 5] == [s for k, s, e in secret_scan.find(f"{PROSE}sent {token} on") if k == "novel" and e - s == len(token)]


CLEAN = """getAccessTokenFromCache AbstractSingletonProxyFactoryBean session_cookie_secure_flag XMLHttpRequestEventTarget SPRING_DATASOURCE_PASSWORD kubernetes_service_account_token
self.client.get_secret(name) process.env.SECRET_KEY org.apache.spark.sql.functions --no-password-prompt README.md#L120-L140 ${{secrets.GITHUB_TOKEN}} user@example.com 2024-01-05T10:00:00Z
192.168.100.200:8080 <your-api-key-here> xxxxxxxxxxxxxxxxxxxx **************** sha256sum application/x-www-form-urlencoded /usr/lib/python3.11/site-packages https://docs.example.com/v2/guide/index.html?id=1291
internationalization Wahrscheinlichkeitsrechnung Geschwindigkeitsbegrenzung 日本語の文章には空白がないので長い列になります""".split()


def test_what_is_no_secret():
    for word in CLEAN:
        assert secret_scan.find(f"{PROSE}The token is kept in {word} and {PROSE}") == [], word


def runs(text, start, allowed):
    end = start
    while end < len(text) and text[end] in allowed:
        end += 1
    return end


def plain_base(text):
    """The base spans, by going from character to character."""
    out, low = [], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    at = 0
    while at < len(text):
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if low.startswith(word, at):
                k = at + len(word)
                k += text[k : k + 1] in ('"', "'") and bool(text[k : k + 1])
                k = runs(text, k, " ")
                if k < len(text) and text[k] in ":=":
                    k = runs(text, k + 1, " ")
                    k += text[k : k + 1] in ('"', "'") and bool(text[k : k + 1])
                    end = runs(text, k, LETTERS + DIGITS + "+/_.=-")
                    if end > k:
                        if end - k >= 6:
                            out.append(("assign", at, end))
                        at = end - 1
                        break
        at += 1
    at = 0
    while (at := text.find("AKIA", at)) >= 0:
        end = runs(text, at + 4, string.ascii_uppercase + DIGITS)
        if end == at + 4:
            at += 1
            continue
        if end - at >= 20:
            out.append(("access", at, end))
        at = end
    at = 0
    while at < len(text):
        end = runs(text, at, DIGITS + "abcdef")
        if end - at >= 24:
            out.append(("hex", at, end))
        at = end + 1
    return sorted(out, key=lambda x: (x[1], secret_scan.KINDS.index(x[0]), x[2]))


def test_base_spans_of_whole_tables(spark):
    import os

    texts = ['token="abcdef"x token=ab token: = x, PASSWD\' =\n\'abcdef api__key=abcdef apikey=abcdefg passwordsecret:abcdef', "AKIAAKIA" + "A1" * 9 + "a AKIA", "f" * 23 + " " + "0f" * 12 + "g", "tokentoken=abcdef secret='token=abcdef"]
    sf = "/root/testdata/sf0.01/documents.parquet"
    if os.path.exists(sf):
        texts += [r.text or "" for r in spark.read.parquet(sf).select("text").collect()]
    found = 0
    for text in texts:
        got = [x for x in secret_scan.find(text) if x[0] != "novel"]
        assert got == plain_base(text), text[:300]
        found += len(got)
    assert found > 8
