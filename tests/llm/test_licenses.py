import random
import re

from quire.llm import licenses

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def base(text):
    """The base columns by the definition."""
    words = re.findall(WORD, lower(text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_by_definition(spark, edge_docs, edge_rows, no_docs):
    r = random.Random(5)
    pieces = ["under", "the", "MIT", "License", "apache", "version", "2", "cc", "by", "nc", ",", "-", "\n", "é", "x\x7fy", "\x00", "中文"]
    texts = ["".join(r.choice(pieces) + r.choice([" ", "-", "\n", ""]) for _ in range(400)) for _ in range(60)]
    texts += ["CC-BY-NC cc by nc/cc by\nnc", "under the mit license" * 2, "under the mit license " * 3000, "", None, "Apache License, Version 2.0",
              "apache license version 20", "sunder the mit license", "éunder the mit license"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, x[1]) for i, x in enumerate(edge_rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x.doc_id: x for x in licenses.scan(spark, df).collect()}
    for i, t in rows:
        x = got[i]
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == base(t)
        assert set(x.base_labels.split(",")) <= set(x.labels.split(",")) | {""} and 0 <= x.score <= 1
    assert sum(x.n_base > 0 for x in got.values()) > 5
    assert licenses.scan(spark, edge_docs).count() == len(edge_rows) and not licenses.scan(spark, no_docs).collect()


def descend(tokens):
    """Recursive descent over a whole expression, against the shunting-yard."""
    at = 0

    def atom():
        nonlocal at
        if tokens[at] == "(":
            at += 1
            out = level(1)
            assert tokens[at] == ")"
            at += 1
            return out  # brackets around one identifier change nothing
        at += 1
        return (*licenses.known(tokens[at - 1]), tokens[at - 1])

    def bound():
        nonlocal at
        left = atom()
        while at < len(tokens) and tokens[at] == "with":
            at += 1
            right = atom()
            if left[2] is None or right[2] is None:
                raise ValueError
            left = left[0] / 2, frozenset(f"{x}-with-{re.sub(r'-[0-9].*$', '', right[2])}" for x in left[1]), None
        return left

    def level(n):
        nonlocal at
        left = bound() if n == 3 else level(n + 1)
        while at < len(tokens) and tokens[at] == {1: "or", 2: "and"}.get(n):
            at += 1
            right = bound() if n == 3 else level(n + 1)
            left = ({1: min, 2: max}[n])(left[0], right[0]), left[1] | right[1], None
        return left

    out = level(1)
    assert at == len(tokens)
    return out[0], frozenset(out[1])


def test_expressions_by_recursive_descent():
    r = random.Random(8)
    names = ["mit", "apache-2.0", "gpl-2.0-only", "agpl-3.0+", "cc-by-nc-4.0", "classpath-exception-2.0", "what-is-this"]

    def make(depth):
        kind = r.randrange(6) if depth else 0
        if kind < 2:
            return [r.choice(names)]
        if kind == 2:
            return ["(", *make(depth - 1), ")"]
        return [*make(depth - 1), r.choice(["or", "and", "with"]), *make(depth - 1)]

    good = 0
    for _ in range(2000):
        line = make(5)
        try:
            want = descend(line)
            good += 1
        except ValueError:
            want = (licenses.UNKNOWN, frozenset())
        assert licenses.expression(b": " + " ".join(line).replace("( ", "(").encode()) == want
    assert good > 500


def labels(text):
    row = licenses.scan_text(text.encode())
    return row[5], row[6]


def test_tags_and_notices():
    assert labels("// SPDX-License-Identifier: MIT OR GPL-3.0-or-later\ncode") == ("gpl-3,mit", 0.1)
    assert labels("# SPDX-License-Identifier: MIT AND GPL-3.0-or-later") == ("gpl-3,mit", 0.7)
    assert labels("/* spdx-license-identifier: (MIT OR BSD-3-Clause) AND GPL-2.0-only WITH Classpath-exception-2.0 */") == (
        "bsd,gpl-2-with-classpath-exception,mit", 0.35)
    assert labels("License: Apache-2.0. See the file.") == ("apache-2", 0.2)
    assert labels('license = "MIT"') == ("mit", 0.1)
    assert labels("SPDX-License-Identifier: MIT OR\nGPL-3.0") == ("", licenses.UNKNOWN)
    assert labels("SPDX-License-Identifier: (MIT OR ISC") == ("", licenses.UNKNOWN)
    assert labels("License: none of your business") == ("", 0.0)
    assert labels("the license says much, and more") == ("", 0.0)
    assert labels("This work is licensed under the GNU General Public License, version 3.") == ("gpl-3", 0.7)
    assert labels("Released under the MIT License.") == ("mit", 0.1)
    assert labels("Licensed under CC BY-NC 4.0.") == ("cc-by-nc", 0.9)
    assert labels("Licensed under CC BY-NC-SA 4.0.") == ("cc-by-nc,cc-by-nc-sa", 0.9)
    assert labels("Licensed under the Apache License, Version 2.0.") == ("apache-2", 0.2)
    assert labels("SPDX-License-Identifier: " + "(" * 5000 + "MIT" + ")" * 5000) == ("mit", 0.1)
    assert labels("SPDX-License-Identifier: MIT" + " OR ISC" * 50_000) == ("isc,mit", 0.1)
