"""The labelled table of the personal-data field, made by a rule: writings of personal data put into contexts.

`{kind:span}` marks a span, all else is outside. In a writing 9 is any digit, U a name and H a host, T a top-level domain,
I a part of an address; C stands for the digits of a card that passes its checksum.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

# --- Fixed values: writings and contexts -------------------------------------------------

# Writings that are a phone number by themselves, whatever is around them.
PLAIN_PHONES = [
    "(099) 9999 9999", "(099) 999999", "(999) 999-9999", "(0999) 999999", "+49 999 9999999", "+1 999 999 9999",
    "+33 9 99 99 99 99", "+44999999999",
]
# Writings that are one only where the words around them say so.
PHONES = [
    "099 9999999", "0999 9999999", "0999 999 99999", "099-9999999", "099/9999999", "0999/999999", "0800 9999999",
    "999-999-9999", "999.999.9999", "999 999 9999", "1 999 999 9999", "1-999-999-9999", "0049 999 9999999",
    "001 999 999 9999", "09 99 99 99 99", "09.99.99.99.99", "99 999 99 99", "099 999999",
]
EMAILS = [
    "U [at] H [dot] T", "U (at) H (dot) T", "U.U [at] H [dot] H [dot] T", "U [at] H.T", "U (at) H.T", "U [at] H.H.T", "U (at) H.H.T", "U at H dot T",
    "U at H dot H dot T", "U[at]H[dot]T", "U(at)H(dot)T", "U.U[at]H[dot]T", "U[at]H.T", "U(at)H.T", "U<at>H<dot>T",
    "U{at}H{dot}T", "U9[at]H[dot]T", "U_U(at)H.H.T", "U-U[at]H[dot]H[dot]T", "U <at> H <dot> T", "U@H.T", "U.U@H.H.T",
]
ADDRESSES = ["I.I.I.I", "I[.]I[.]I[.]I", "I(.)I(.)I(.)I", "I[.]I.I.I", "I[dot]I[dot]I[dot]I"]
CARDS = ["C C C C", "C-C-C-C", "C.C.C.C", "C/C/C/C", "CCCC"]

CALLS = [
    "call", "please call", "phone", "phone:", "tel", "tel.", "tel:", "telephone", "mobile", "mobile:", "ring", "fax", "fax:",
    "dial", "hotline", "sms", "call me at", "call us on", "my number is", "phone number:", "reach me on", "cell",
    "whatsapp", "ring me on", "anrufen unter", "telefon", "appelez le", "llame al", "contact us at",
]
AFTER_CALLS = ["before noon", "today", "for help", "please", "now", "after six", ".", ", thanks", "", "or write", "anrufen", "demain"]
WRITE = ["write to", "mail", "email", "e-mail:", "contact", "send it to", "reach us at", "please mail", "from", "answer to"]
AFTER_WRITE = ["soon", "please", "now", "today", ".", "", "for more", "and wait"]
HOSTS = ["host", "from", "address", "server", "ip", "the node", "login by", "ping"]
AFTER_HOSTS = ["is up", "denied", "lost", "blocked", ".", "answered", ""]
PAID = ["card", "paid by", "charged to", "card no.", "visa", "credit card"]
AFTER_PAID = ["charged", "today", ".", "expired", ""]
# Words before and after numbers that are nobody's.
COUNTED = [
    "product", "part", "serial", "order", "invoice", "item", "total", "sum of", "batch", "lot", "article", "ticket", "case",
    "record", "model", "account", "score", "section", "stock", "code", "id", "values", "between", "with", "the", "and", "of",
    "in", "was", "file", "line", "number of items", "count", "reference", "range", "catalogue",
]
AFTER_COUNTED = ["boxes", "units", "pieces", "shipped", "listed", "in stock", "printed", "sold", "were found", ".", "", "and more", "euros", "rows"]
NAMES = ["anna", "john", "peter", "maria", "kim", "info", "sales", "office", "x", "lee", "support", "hans", "webmaster"]
HOST_NAMES = ["example", "mail", "site", "firm", "post", "school", "web", "corp", "net1", "shop"]
DOMAINS = ["org", "com", "net", "de", "fr", "edu", "info", "co"]

# Lines without personal data, as they are.
OTHERS = [
    "on 2024-01-05 at 10:30 we met", "on 05.01.2024 at 9 we met", "in 1999 and 2003 there were 12 cases",
    "between 1914 1918 and 1939 1945", "costs 12.50 or 1,299.00 euros", "version 1.2.3 of 4.5 was built",
    "chapter 12 page 345 line 6", "numbers 1 2 3 4 5 6 7 8 9", "scores 12 15 18 21 24 27 30 34",
    "table 120 340 560 780 910 230 450", "ratio 3:4 and 16:9 of 100%", "key 9f8e7d6c5b4a39281706 used",
    "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" set", "id 47853805 given", "order 123456 sent 20240105 ok",
    "article 4785380592391138 listed", "read dot by dot and line by line", "the dot is red", "connect dot to dot now",
    "see http://example.com/fr/825?page=2 there", "user1 and user22 and b52 came", "a1 b2 c3 d4 rows",
    "10,000 people and 1.5 million", "isbn 978-3-16-148410-0 printed", "room 101 floor 3 gate 7",
    "zip 10115 berlin and 75001 paris", "win 3-2 or 10-1 or 2-2", "mention @home or @ noon", "4 8 15 16 23 42 are drawn",
    "### 152 $$$ 12 &&& 7 %%%", "we met at noon by the dot", "look at the dot at the end", "a dot at a time",
    "at the dot we turn", "call 3 times before 10", "phone costs 199.99 today", "call on 2024-05-06 at 10:30 please",
    "tel aviv 2024 summer", "ring 3 bells at 7", "mail 20 letters in 5 days", "write 500 words by 10 june",
    "the call 1 of 12 was short", "mobile 5 is out", "version 10.4.2 beta 7", "row 7 seat 12 gate 34",
]


def _card(r: random.Random) -> str:
    """Sixteen digits that pass the checksum."""
    digits = [4, *(r.randrange(10) for _ in range(14))]
    doubled = [d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)]
    return "".join(map(str, [*digits, -sum(doubled) % 10]))


def _written(form: str, r: random.Random) -> str:
    """A writing with its letters filled in."""
    card, at, out = _card(r), 0, []
    for c in form:
        if c == "9":
            out.append(str(r.randrange(10)))
        elif c == "I":
            # Short parts as often as long ones.
            out.append(str(r.randrange((10, 100, 256)[r.randrange(3)])))
        elif c == "C":
            out.append(card[at : at + 4])
            at += 4
        else:
            out.append(r.choice({"U": NAMES, "H": HOST_NAMES, "T": DOMAINS}.get(c, [c])))
    return "".join(out)


def _grouped(r: random.Random) -> str:
    """A form of 9 to 13 digits in groups that one sign keeps apart."""
    groups = [r.randrange(2, 5) for _ in range(5)]
    while sum(groups) > 13 or (len(groups) > 3 and sum(groups[:-1]) >= 9):
        groups.pop()
    first = r.choice(["", "", "9", "00"])
    return r.choice(" -./").join([*([first] if first else []), *("9" * g for g in groups)])


def _line(before: str, kind: str | None, span: str, after: str) -> str:
    marked = f"{{{kind}:{span}}}" if kind else span
    return f"{before} {marked}{after if after[:1] in ('.', ',') else ' ' + after}".strip()


def labelled(seed: int = 11, each: int = 5) -> Iterator[str]:
    """Every writing `each` times in contexts of its kind, phone-like ones as often where they count something."""
    r = random.Random(seed)
    # As many forms made by chance as there are given ones.
    grouped = [_grouped(r) for _ in PHONES]
    kinds = [
        ("phone", PLAIN_PHONES, CALLS, AFTER_CALLS), ("phone", PLAIN_PHONES, ["the", "and", "or", "so", "yes"], AFTER_CALLS),
        ("phone", PHONES + grouped, CALLS, AFTER_CALLS), (None, PHONES + grouped, COUNTED, AFTER_COUNTED),
        ("email", EMAILS, WRITE, AFTER_WRITE),
        ("ip", ADDRESSES, HOSTS, AFTER_HOSTS), ("card", CARDS, PAID, AFTER_PAID),
    ]
    for kind, forms, befores, afters in kinds:
        # Each context comes as often as another.
        first = r.sample(befores, len(befores)) * (1 + len(forms) * each // len(befores))
        for i in range(len(forms) * each):
            # A card's braces would end the mark.
            span = _written(forms[i % len(forms)], r).replace("{", "<").replace("}", ">")
            yield _line(first[i], kind, span, r.choice(afters))
    yield from OTHERS


LINES = list(labelled())
