"""Labelled texts to train the personal-data trees from, made by what they are and not by how they look.

A template is a text with a place for a value, the kind of personal data that a value there would be (or that it
looks like), and the truth.  Words of no meaning stand around it, so that a missing context is learned as
well as a telling one.  Of the templates of a kind and truth every fourth is held back from training; the thresholds
are set on those.
"""

from __future__ import annotations

import random

PER_TEMPLATE = 24
HELD_BACK = 4

#: (kind, label, text around the value, kind of value).
TEMPLATES = [
    ("email", 1, "write to {} please", "said_email"),
    ("email", 1, "contact: {}", "said_email"),
    ("email", 1, "~ {} ~", "said_email"),
    ("email", 1, "my address is {} , ask there", "said_email"),
    ("email", 1, "mail {} or call", "wide_email"),
    ("email", 1, "~ {} ~", "wide_email"),
    ("email", 1, "e-mail: {}", "wide_email"),
    ("email", 0, "we met {} today", "at_place"),
    ("email", 0, "~ look {} ~", "at_place"),
    ("email", 0, "they were {} and left", "at_place"),
    ("email", 0, "install {} first", "package"),
    ("email", 0, "~ {} ~", "package"),
    ("ip", 1, "connected from {} at noon", "ipv6"),
    ("ip", 1, "~ {} ~", "ipv6"),
    ("ip", 1, "host {} is up", "ipv6"),
    ("ip", 1, "user logged in from {} twice", "said_ip"),
    ("ip", 1, "~ {} ~", "said_ip"),
    ("ip", 0, "at {} the train left", "clock"),
    ("ip", 0, "~ {} ~", "clock"),
    ("ip", 0, "duration {} in all", "clock"),
    ("ip", 0, "~ see {} ~", "ratio"),
    ("card", 1, "my card number is {} valid", "card"),
    ("card", 1, "paid by visa {} today", "card"),
    ("card", 1, "credit card: {}", "wide_card"),
    ("card", 1, "~ {} ~", "wide_card"),
    ("card", 1, "charge the card {} now", "mistyped_card"),
    ("card", 1, "credit card no. {} please", "mistyped_card"),
    ("card", 1, "visa {} expires", "mistyped_card"),
    ("card", 0, "~ {} ~", "digits16"),
    ("card", 0, "~ {} ~", "mistyped_card"),
    ("card", 0, "order {} was sent", "digits16"),
    ("card", 0, "tracking number {} is open", "digits16"),
    ("card", 0, "~ {} ~", "digits13"),
    ("card", 0, "isbn {} in print", "digits13"),
    ("card", 0, "invoice {} of today", "digits14"),
    ("card", 0, "~ {} ~", "numbers"),
    ("card", 0, "table {} ends", "numbers"),
    ("card", 0, "timestamp {} in the log", "digits13"),
    ("phone", 1, "call me at {} tonight", "national_phone"),
    ("phone", 1, "phone: {}", "national_phone"),
    ("phone", 1, "tel. {} (office)", "national_phone"),
    ("phone", 1, "~ mobile {} ~", "national_phone"),
    ("phone", 1, "~ {} ~", "bracket_phone"),
    ("phone", 1, "fax {} ~", "bracket_phone"),
    ("phone", 1, "reach her on {} any time", "double_zero_phone"),
    ("phone", 1, "~ {} ~", "double_zero_phone"),
    ("phone", 1, "whatsapp {} now", "digits10"),
    ("phone", 0, "~ {} ~", "digits10"),
    ("phone", 0, "~ {} ~", "digits8"),
    ("phone", 0, "order {} was sent", "digits10"),
    ("phone", 0, "on {} we met", "date"),
    ("phone", 0, "~ {} ~", "date"),
    ("phone", 0, "version {} is out", "version"),
    ("phone", 0, "~ {} ~", "version"),
    ("phone", 0, "~ {} ~", "numbers"),
    ("phone", 0, "pages {} of it", "page_range"),
    ("phone", 0, "in {} the war", "years"),
    ("phone", 0, "part no {} fits", "digits8"),
    ("phone", 0, "~ {} ~", "digits16"),
    ("phone", 0, "invoice {} of today", "digits12"),
    ("phone", 0, "a price of {} in all", "amount"),
    ("iban", 1, "account {} at the bank", "iban"),
    ("iban", 1, "iban: {}", "iban"),
    ("iban", 1, "~ {} ~", "iban"),
    ("iban", 1, "transfer to {} today", "spaced_iban"),
    ("iban", 1, "~ {} ~", "spaced_iban"),
    ("iban", 0, "~ {} ~", "like_iban"),
    ("iban", 0, "part {} fits", "like_iban"),
    ("iban", 0, "serial {} of it", "like_iban"),
    ("iban", 0, "key {} was found", "like_iban"),
    ("id", 1, "ssn {} on file", "ssn"),
    ("id", 1, "social security number: {}", "ssn"),
    ("id", 1, "his ssn is {} ~", "ssn"),
    ("id", 1, "taxpayer id {} ~", "ssn"),
    ("id", 0, "part no {} fits", "ssn"),
    ("id", 0, "~ {} ~", "ssn"),
    ("id", 0, "order {} was sent", "ssn"),
    ("id", 0, "version {} is out", "ssn"),
]

_DIGITS, _LETTERS, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
_SOUNDS = "an be chen der ea for gel ing ja ku lor men nto os per que ri sta tion und ver wo".split()
_PLACES = "home work school noon night once last least all".split()
_ENDINGS = "com org net de fr es co.uk io".split()


def _luhn(body: str) -> str:
    """body and its check digit."""
    total = sum(d if i % 2 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(map(int, reversed(body))))
    return body + str(-total % 10)


def _iban(country: str, body: str) -> str:
    number = int("".join(str(int(c, 36)) for c in f"{body}{country}00"))
    return f"{country}{98 - number % 97:02d}{body}"


def _value(kind: str, rng: random.Random) -> str:
    some = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    word = lambda: "".join(rng.choice(_SOUNDS) for _ in range(rng.randint(1, 3)))
    grouped = lambda s, by: by.join(s[i : i + 4] for i in range(0, len(s), 4))
    if kind.startswith("digits"):
        return rng.choice("123456789") + some(_DIGITS, int(kind[6:]) - 1)
    match kind:
        case "said_email":
            at, dot = rng.choice([(" (at) ", "."), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" at ", " dot "), ("[at]", "."), (" AT ", " DOT "), (" (@) ", ".")])
            return f"{word()}{rng.choice(['.', '_', ''])}{word()}{at}{word()}{dot}{rng.choice(_ENDINGS[:6])}"
        case "wide_email":
            return f"{word()}{rng.choice('äöüéñ')}{word()}@{word()}{rng.choice('äöüéñ')}{word()}.{rng.choice(_ENDINGS)}"
        case "at_place":
            return rng.choice([f"{word()} at {rng.choice(_PLACES)}.{word().capitalize()}", f"{word()} at {word()}.{word()}"])
        case "package":
            return f"{word()} @ {some(_DIGITS, 1)}.{some(_DIGITS, 2)}.{some(_DIGITS, 1)}"
        case "ipv6":
            parts = [some(_HEX, rng.randint(1, 4)) for _ in range(8)]
            return rng.choice([":".join(parts), "2001:db8::" + parts[0] + ":" + parts[1], "fe80::" + ":".join(parts[:4])])
        case "said_ip":
            return rng.choice(["[.]", "(.)", " dot "]).join(str(rng.randint(1, 254)) for _ in range(4))
        case "clock":
            return f"{rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:{rng.randint(0, 59):02d}"
        case "ratio":
            return ":".join(str(rng.randint(1, 40)) for _ in range(3))
        case "card":
            return _luhn(rng.choice(["4", "51", "52", "37", "6011"]) + some(_DIGITS, 11))[: rng.choice([13, 16])]
        case "wide_card":
            number = rng.choice(["4", "5"]) + some(_DIGITS, 14)
            return grouped(_luhn(number), rng.choice(["  ", ".", " - "[:2]]))
        case "mistyped_card":
            number = _luhn(rng.choice(["4", "5"]) + some(_DIGITS, 14))
            return number[:15] + str((int(number[15]) + rng.randint(1, 9)) % 10)
        case "numbers":
            return " ".join(some(_DIGITS, rng.randint(1, 3)) for _ in range(rng.randint(6, 9)))
        case "national_phone":
            return rng.choice([f"0{some(_DIGITS, 3)}/{some(_DIGITS, 7)}", f"{some(_DIGITS, 3)}-{some(_DIGITS, 3)}-{some(_DIGITS, 4)}", f"0{some(_DIGITS, 2)} {some(_DIGITS, 4)} {some(_DIGITS, 4)}", f"{some(_DIGITS, 3)}-{some(_DIGITS, 4)}", f"0{some(_DIGITS, 1)} {' '.join(some(_DIGITS, 2) for _ in range(4))}"])
        case "bracket_phone":
            return f"({some(_DIGITS, 3)}) {some(_DIGITS, 3)}-{some(_DIGITS, 4)}"
        case "double_zero_phone":
            return f"00{some('123456789', 2)} {some(_DIGITS, 3)} {some(_DIGITS, 7)}"
        case "date":
            return rng.choice([f"20{some(_DIGITS, 2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}", f"{rng.randint(10, 28)}.0{rng.randint(1, 9)}.20{some(_DIGITS, 2)}", f"{rng.randint(10, 28)}/1{rng.randint(0, 2)}/19{some(_DIGITS, 2)}"])
        case "version":
            return f"{rng.randint(1, 20)}.{some(_DIGITS, 2)}.{some(_DIGITS, 4)}.{some(_DIGITS, 1)}"
        case "page_range":
            return f"{rng.randint(1000, 2000)}-{rng.randint(2001, 2999)}"
        case "years":
            return f"19{some(_DIGITS, 2)}-20{some(_DIGITS, 2)}"
        case "amount":
            return f"{rng.randint(1, 9)}.{some(_DIGITS, 3)}.{some(_DIGITS, 3)}"
        case "iban":
            return _iban(rng.choice(["DE", "FR", "ES", "GB"]), some(_DIGITS, 18))
        case "spaced_iban":
            return grouped(_iban(rng.choice(["DE", "FR", "ES", "NL"]), some(_DIGITS, 18)), " ")
        case "like_iban":
            return some("ABCDEFGHKLMNPQRSTUVWXYZ", 2) + some(_DIGITS, 2) + some("ABCDEFGH" + _DIGITS, rng.randint(12, 20))
        case _:
            return f"{rng.randint(100, 899)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"


def labelled_texts(per_template: int = PER_TEMPLATE, seed: int = 7) -> list[tuple[str, int, list[tuple[str, int, int]]]]:
    """(text, fold, personal spans (kind, start, end)); fold 0 is held back.  Always the same."""
    rng = random.Random(seed)
    rows = []
    so_far = dict.fromkeys(((kind, label) for kind, label, _, _ in TEMPLATES), -1)
    for kind, label, around, value in TEMPLATES:
        so_far[kind, label] += 1
        for _ in range(per_template):
            before, after = around.split("{}")
            noise = lambda s: " ".join(" ".join("".join(rng.choice(_SOUNDS) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(2, 5))) if w == "~" else w for w in s.split(" "))
            before, made, after = noise(before), _value(value, rng), noise(after)
            rows.append((before + made + after, so_far[kind, label] % HELD_BACK, [(kind, len(before), len(before) + len(made))] if label else []))
    return rows
