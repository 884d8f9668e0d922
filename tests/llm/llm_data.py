"""Small documents with the hard cases, and plain-Python words."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def space_words(s):
    return re.findall(r"[^\x20\x09-\x0D]+", s or "")


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "Éa", "on", "in"]) + rng.choice(["", "ha", "ère", "st,", "ing."]) + str(rng.randint(0, 9))
                    for _ in range(n))


def documents(seed=1):
    """(doc_id, text, lang, source, n_chars) rows: NULLs, empty, long, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    passage = prose(rng, 60)
    words = base.split()
    near = [" ".join([*words[:i], "changed", *words[i + 1:]]) for i in (3, 60, 118)]
    texts = [base, base, *near, None, "", " \n\t ", "one two", "one two", "Thor " * 300, "aaaa" * 200,
             prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 30), passage + " " + prose(rng, 20),
             prose(rng, 6000), "é" * 150 + prose(rng, 5) + "é" * 150, "x\ny\nx\n\n \nx\ny", "<|endoftext|> it's 'tis é   漢字!?#12"]
    texts += [prose(rng, rng.randint(1, 150)) for _ in range(20)]
    rows = [(i * 3, t, ["en", "fr", None][i % 3], f"src{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append((None, prose(rng, 50), "en", "src0", 1))
    rows.append((None, None, None, None, None))
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
