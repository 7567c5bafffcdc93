"""Small tables with the awkward cases every operator must survive."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq

WORDS = ("the of and river stone light under morning paper window little garden walked slowly "
         "answer better colour mountain seven yellow evening bridge market winter").split()
GERMAN = ("der die und nicht schloß straße über können müssen zwischen würde größe ähnlich "
          "wörter häuser bäume schön grün möglich ich auch werden haben").split()


def sentence(rng: random.Random, n: int, words=WORDS) -> str:
    return " ".join(rng.choice(words) + (str(rng.randrange(40)) if rng.random() < 0.4 else "")
                    for _ in range(n))


def documents(seed: int = 1) -> list[dict]:
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", " \t\n", "word", "Two words", "12 34 !!", "%%% ###"]
    base = sentence(rng, 60)
    texts += [base] * 8  # exact copies
    for i in range(12):  # near copies of one text
        words = base.split()
        for _ in range(1 + i % 5):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        texts.append(" ".join(words))
    texts += [base.upper(), base.replace(" ", "  \n")]
    texts += [sentence(rng, rng.randrange(5, 120)) for _ in range(30)]
    texts += [sentence(rng, rng.randrange(20, 90), GERMAN) + ".\nÄ ende" for _ in range(25)]
    texts.append(sentence(rng, 30_000))  # very long
    texts.append("é" * 5000)
    rows = [{"doc_id": i, "text": t, "lang": "de" if t and "ä" in t.lower() else "en",
             "source": f"src{i % 5}" if i % 3 else "src0"} for i, t in enumerate(texts)]
    rows[3]["lang"] = rows[4]["lang"] = None
    rows[5]["source"] = rows[6]["source"] = None
    rows.append(dict(rows[20]))  # a repeated row
    rows.append({"doc_id": None, "text": base, "lang": None, "source": None})
    return rows


# Columns of the input whose names the operators use themselves.
CLASHES = ["n_words", "size", "shard", "slot", "key", "score", "body", "rep", "h", "start", "n_tokens"]


def write(folder, docs: list[dict], benchmark=None, labels=None, pages=None, embeddings=None) -> str:
    """Write the five tables under ``folder``; empty lists give empty tables."""
    string, big, small = pa.string(), pa.int64(), pa.int32()
    extra = {c: big for c in CLASHES}
    tables = {
        "documents": ([{**{c: 7 for c in CLASHES}, **d} for d in docs],
                      {"doc_id": big, "text": string, "lang": string, "source": string, "n_chars": big, **extra}),
        "benchmark": (benchmark or [], {"item_id": big, "text": string, "n_words": big}),
        "labels": (labels or [], {"doc_id": big, "quality": small, "toxic": small, "score": big}),
        "pages": (pages or [], {"page_id": big, "url": string, "html": string, "position": big, "n": big}),
        "embeddings": (embeddings or [], {"vec_id": big, "embedding": pa.list_(pa.float32()), "label": small,
                                          "id": big, "rank": big}),
    }
    for name, (rows, types) in tables.items():
        schema = pa.schema(list(types.items()))
        columns = {c: [r.get(c) for r in rows] for c in types}
        pq.write_table(pa.table(columns, schema=schema), f"{folder}/{name}.parquet")
    return str(folder)


def folder(tmp_path_factory) -> str:
    docs = documents()
    rng = random.Random(5)
    base = docs[7]["text"]
    bench = [
        {"item_id": 1, "text": " ".join(base.split()[10:40])},
        {"item_id": 2, "text": docs[31]["text"]},
        {"item_id": 3, "text": "Two words"},
        {"item_id": 4, "text": " ".join(base.split()[20:33])},
        {"item_id": 5, "text": None}, {"item_id": 6, "text": ""}, {"item_id": None, "text": base},
        {"item_id": 7, "text": sentence(rng, 50)},
        {"item_id": 7, "text": "river stone7 light"},
        {"item_id": 10, "text": "word"},
    ]
    labels = [{"doc_id": i, "quality": i % 2, "toxic": 0} for i in range(0, 60)]
    labels += [{"doc_id": 3, "quality": None, "toxic": None}, {"doc_id": None, "quality": 1, "toxic": 0},
               {"doc_id": 8, "quality": 1, "toxic": 0}]
    big = "<p>" + "payload é " * 200 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    pages = [{"page_id": i, "url": f"http://www.Site{i % 3}.example.org/p/{i % 4}?q={i}#frag", "html": h}
             for i, h in enumerate([None, "", "x" * 999, "x" * 999, big, big, big, "\r\n" * 800,
                                    "\r\n" * 800, "a" * 1000, "é" * 500, "é" * 500, big + "\r\n", "tail\r\n\r\n"])]
    pages += [{"page_id": 40, "url": None, "html": big}, {"page_id": 41, "url": "no scheme\r\n here", "html": "z"},
              {"page_id": 42, "url": "https://host", "html": "y" * 300_000}]
    vecs = [{"vec_id": i, "embedding": [float(rng.uniform(-1, 1)) for _ in range(20)], "label": 0} for i in range(220)]
    vecs += [{"vec_id": 300, "embedding": None}, {"vec_id": 350, "embedding": []},
             {"vec_id": 400, "embedding": [1.0] * 19 + [None]}, {"vec_id": 450, "embedding": [float("nan")] * 20},
             {"vec_id": 500, "embedding": [float("inf")] * 20}, {"vec_id": 550, "embedding": [1.0, 2.0]},
             {"vec_id": None, "embedding": [0.5] * 20}]
    vecs += [{"vec_id": 600 + i, "embedding": list(vecs[50]["embedding"])} for i in range(9)]  # ties
    return write(tmp_path_factory.mktemp("awkward"), docs, bench, labels, pages, vecs)


def empty_folder(tmp_path_factory) -> str:
    return write(tmp_path_factory.mktemp("empty"), [])
