"""Labelled findings to train the secret scan from, made by what they are and not by how they look.

A template is a place where a value stands, with a kind of value and the truth about it: a key, or
something that only looks like one.  Values are drawn at random by a fixed seed.  Families of
templates are the unit to hold out when precision and recall are measured.
"""

from __future__ import annotations

import random

PER_TEMPLATE = 30
_LETTERS, _UPPER, _DIGITS, _HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
_BASE64 = _LETTERS + _UPPER + _DIGITS + "+/"

#: (family, label, path, text around the value, kind of value).
TEMPLATES = [
    ("code", 1, "src/app.py", 'token = "{}"', "hex40"),
    ("code", 1, "src/app.py", 'API_KEY = "{}"', "alnum32"),
    ("code", 1, "src/main.go", 'secret := "{}"', "base64_44"),
    ("code", 1, "src/db.js", "const password = '{}';", "password"),
    ("code", 1, "lib/auth.rb", "private_key: '{}'", "hex64"),
    ("code", 0, "tests/test_app.py", 'token = "{}"', "placeholder"),
    ("code", 0, "docs/example.md", "password = '{}'", "placeholder"),
    ("code", 0, "src/app.py", 'checksum = "{}"', "hex40"),
    ("code", 0, "src/app.py", 'image_hash = "{}"', "hex64"),
    ("code", 0, "src/theme.css", 'id="{}"', "slug"),
    ("code", 0, "src/app.py", "token = {}", "word"),
    ("conf", 1, "conf/prod.yaml", "api_key: {}", "alnum32"),
    ("conf", 1, "deploy/.env", "DB_PASSWORD={}", "password"),
    ("conf", 1, "deploy/.env", "AWS_SECRET_ACCESS_KEY={}", "base64_40"),
    ("conf", 1, "conf/app.ini", "password={}", "hex18"),
    ("conf", 1, "conf/app.json", '"client_secret": "{}"', "alnum24"),
    ("conf", 1, "conf/app.json", '"password": "{}"', "phrase"),
    ("conf", 0, "conf/app.yaml", "version: {}", "release"),
    ("conf", 0, "conf/app.yaml", "image: {}", "path"),
    ("conf", 0, "sample/app.env", "SECRET_KEY={}", "placeholder"),
    ("conf", 0, "conf/app.yaml", "key: {}", "word"),
    ("conf", 0, "conf/app.yaml", "session: {}", "word"),
    ("prose", 1, "page", "the key {} was found", "aws"),
    ("prose", 1, "page", "they wrote {} in the chat", "github"),
    ("prose", 1, "page", "then password={} and more", "hex18"),
    ("prose", 1, "page", 'of it token = "{}" and so on', "hex40"),
    ("prose", 1, "chat", "my password: {} ok", "password"),
    ("prose", 1, "notes", 'password = "{}"', "phrase"),
    ("prose", 0, "page", "the card {} was used", "digits16"),
    ("prose", 0, "page", "and then {} of it", "digits16"),
    ("prose", 0, "page", "call {} for help", "digits17"),
    ("prose", 0, "page", "the account {} is open", "iban"),
    ("prose", 0, "page", "see {} for more", "slug"),
    ("prose", 0, "page", "the key: {} kind", "word"),
    ("prose", 0, "page", "author: {} said", "word"),
    ("prose", 0, "page", "order number {} came", "digits18"),
    ("logs", 1, "run.log", "Authorization: Bearer {}", "jwt"),
    ("logs", 1, "run.log", "login with pwd={} failed", "password"),
    ("logs", 1, "run.log", "using {} now", "aws"),
    ("logs", 1, "run.log", "connect to postgres://admin:{}@db.local/main", "password"),
    ("logs", 1, "run.log", "clone https://bot:{}@git.local/a.git", "alnum24"),
    ("logs", 0, "run.log", "commit {} by me", "hex40"),
    ("logs", 0, "run.log", "sha256 {} ok", "hex64"),
    ("logs", 0, "run.log", "md5: {} ok", "hex32"),
    ("logs", 0, "run.log", "request id {} done", "uuid"),
    ("logs", 0, "run.log", "GET {} 200", "path"),
    ("logs", 0, "run.log", "build {} passed", "release"),
    ("logs", 0, "run.log", "session: {} began", "word"),
    ("keys", 1, "page", "{}", "aws"),
    ("keys", 1, "page", "{}", "stripe"),
    ("keys", 1, "page", "{}", "pem"),
    ("keys", 1, "page", "a {} b", "base64_64"),
    ("keys", 1, "page", "the {} of", "github"),
    ("keys", 0, "page", "{}", "digits16"),
    ("keys", 0, "page", "{}", "uuid"),
    ("keys", 0, "page", "{}", "slug"),
    ("keys", 0, "page", "{}", "path"),
    ("keys", 0, "page", "revision {}", "hex40"),
    ("forms", 1, "app.py", 'passwd = "{}"', "password"),
    ("forms", 1, "app.py", "auth_token='{}'", "alnum32"),
    ("forms", 1, "notes", 'secret = "{}"', "phrase"),
    ("forms", 1, "env.sh", "export GITHUB_TOKEN={}", "github"),
    ("forms", 1, "env.sh", 'STRIPE_KEY="{}"', "stripe"),
    ("forms", 0, "users.csv", "user id {}", "uuid"),
    ("forms", 0, "app.py", 'api_key = "{}"', "placeholder"),
    ("forms", 0, "sums.txt", "digest {}", "hex64"),
    ("forms", 0, "page", "password: {}", "word"),
    ("forms", 0, "page", "phone {}", "digits17"),
]

_WORDS = "account banana client commit correct document green header image index introduction large morning orange paper public required river section small string summary table value window".split()
_SHORT = "a all be best false it Jones kind no None null of public required Smith string true value yes".split()
_PLACEHOLDERS = "changeme default dummy example fake placeholder sample test your".split()


def _value(kind: str, rng: random.Random) -> str:
    some = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    name = kind.rstrip(_DIGITS).rstrip("_")
    n = int(kind[len(name) :].lstrip("_") or 0)
    match name:
        case "hex":
            return some(_HEX, n)
        case "alnum":
            return some(_LETTERS + _UPPER + _DIGITS, n)
        case "digits":
            return some(_DIGITS, n)
        case "base64":
            return some(_BASE64, n)
        case "aws":
            return "AKIA" + some(_UPPER + _DIGITS, 16)
        case "github":
            return "ghp_" + some(_LETTERS + _UPPER + _DIGITS, 36)
        case "stripe":
            return "sk_live_" + some(_LETTERS + _UPPER + _DIGITS, 24)
        case "jwt":
            return "eyJ" + some(_BASE64[:62], 17) + "." + some(_BASE64[:62], 40) + "." + some(_BASE64[:62], 43)
        case "pem":
            return "-----BEGIN PRIVATE KEY-----\n" + some(_BASE64, 64) + "\n" + some(_BASE64, 30) + "\n-----END PRIVATE KEY-----"
        case "password":
            return rng.choice(_WORDS).capitalize()[: rng.randint(2, 5)] + some(_DIGITS + "!#$%&*?", rng.randint(3, 6)) + some(_LETTERS, rng.randint(0, 4))
        case "phrase":
            return " ".join([*rng.sample(_WORDS, rng.randint(2, 4)), *rng.sample(_SHORT, rng.randint(0, 2))]) + some(_DIGITS, rng.randint(0, 2)) + rng.choice(["", "!", " " + some(_DIGITS, 1) + "!"])
        case "placeholder":
            return "-".join([rng.choice(_PLACEHOLDERS), *rng.sample(_PLACEHOLDERS + _WORDS, 2), some(_DIGITS, rng.randint(1, 8))])
        case "uuid":
            return "-".join(some(_HEX, k) for k in (8, 4, 4, 4, 12))
        case "slug":
            return "_".join([*rng.sample(_WORDS, 3), some(_DIGITS, rng.randint(1, 4))])
        case "path":
            return "/".join([*rng.sample(_WORDS, 3), rng.choice(_WORDS) + some(_DIGITS, 2)])
        case "release":
            return f"release-20{some(_DIGITS, 2)}-{some(_DIGITS, 2)}-build-{some(_DIGITS, 6)}"
        case "iban":
            return some(_UPPER, 2) + some(_DIGITS, 20)
        case _:
            return rng.choice(_WORDS + _SHORT)


def findings(per_template: int = PER_TEMPLATE, seed: int = 5) -> list[tuple[str, str, int, str]]:
    """(text, path, label, family) of every template, so many times; always the same."""
    rng = random.Random(seed)
    return [(text.format(_value(kind, rng)), path, label, family) for family, label, path, text, kind in TEMPLATES for _ in range(per_template)]
