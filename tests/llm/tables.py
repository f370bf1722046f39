"""Small input folders for the training-data operators."""

import random

import pyarrow as pa
import pyarrow.parquet as pq

DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()),
                       ("n_chars", pa.int64())])
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])
CONVERSATIONS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
LABELS = pa.schema([("doc_id", pa.int64()), ("quality", pa.int64()), ("toxic", pa.int64())])

SYLLABLES = "an er in on re ti the st nd ou ha wh ea le és ñá ßt".split()


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]
    return " ".join(w + ("." if rng.random() < 0.1 else "") for w in words)


def awkward(n: int = 60, seed: int = 1) -> list[dict]:
    """Documents with nulls, empty and long texts, copies, near copies, odd characters and repeated ids."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1] + " end", None, "", " \n\t ", "one", "one two", "A\x1cB\x85C d　e", "x" * 3000,
              "café café <|endoftext|> 中文 \U0001f600", prose(rng, 12_000), "the same " * 40,
              "### *** $$$ %%% " * 10, "WORD!! " * 30, "a | b | c |\n" * 9, "line one here\n" * 5]
    rows = [{"doc_id": i * 3 + 1, "text": t, "lang": None if i % 7 == 0 else "en", "source": "hot" if i % 3 else None,
             "n_chars": None if i % 5 == 0 else i} for i, t in enumerate(texts)]
    rows += [dict(rows[2]), dict(rows[2]), {**rows[3], "doc_id": None}, {**rows[4], "doc_id": None}, {**rows[5], "text": "again"}]
    rng.shuffle(rows)
    return rows


def write(folder, documents: list[dict], labels: list[dict] = (), extra: dict | None = None, files: int = 3) -> str:
    """``folder`` with documents, labels, and pages and conversations made of the documents; ``extra`` adds columns (name -> value)."""
    rng = random.Random(3)
    made = {
        "documents": (DOCUMENTS, documents),
        "pages": (PAGES, [{"page_id": d["doc_id"], "url": d["source"],
                           "html": d["text"] and f"<body><nav><a href=/>menu</a></nav><p>{d['text']}</p></body>"} for d in documents]),
        "conversations": (CONVERSATIONS, [
            {"conv_id": d["doc_id"] and d["doc_id"] % 5, "turn": d["n_chars"] and d["n_chars"] % 9,
             "role": rng.choice(["user", "assistant", "system", None, "", "tool"]), "text": d["text"]} for d in documents]),
    }
    for table, (schema, rows) in made.items():
        for name, value in (extra or {}).items():
            if name not in schema.names:
                schema = schema.append(pa.field(name, pa.int64() if isinstance(value, int) else pa.string()))
        rows = [{**(extra or {}), **r} for r in rows]
        out = folder / f"{table}.parquet"
        out.mkdir(parents=True)
        for i in range(files):
            pq.write_table(pa.Table.from_pylist(rows[i::files], schema), out / f"part-{i}.parquet")
    pq.write_table(pa.Table.from_pylist(list(labels), LABELS), folder / "labels.parquet")
    return str(folder)


def some_labels(documents: list[dict]) -> list[dict]:
    """Labels for most rows: toxic if 'moron' is in the text, bad quality if it has '###'; with nulls and repeats."""
    out = []
    for i, d in enumerate(documents):
        if i % 5 == 4:
            continue
        t = d["text"] or ""
        out.append({"doc_id": d["doc_id"], "quality": None if i % 11 == 0 else int("###" not in t), "toxic": int("moron" in t)})
    return out + out[:2]
