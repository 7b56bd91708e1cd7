"""Small tables with the awkward rows that every operator has to take."""

import random

import pyarrow.parquet as pq

SF_DIR = "/root/testdata/sf0.001"
#: Extra columns, some named like columns the operators make themselves.
EXTRA = "fingerprint long, n_words long, body string, k1 string, rid string, toxicity string, n_lines string"


def read(name, columns):
    return list(zip(*(pq.read_table(f"{SF_DIR}/{name}.parquet")[c].to_pylist() for c in columns)))


def odd_documents():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    long = prose(6000)
    passage = prose(60)
    line = "A line that many of the documents have, " + prose(6)
    docs = [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "word"), (None, prose(40)), (None, None)]
    docs += [(1010, long), (1011, long[:9000] + " changed " + long[9000:]), (1012, passage), (1013, passage)]
    docs += [(1013, passage), (1014, "x " * 300), (1015, "y" * 900), (1016, "y" * 900)]
    docs += [(1020 + k, f"{prose(30)}\n{line}\n{prose(30)}") for k in range(12)]
    docs += [(1040 + k, f"{line}{'!' * k}\n{line[: 20 + k]}\n{prose(3)}") for k in range(4)]
    docs += [(1060 + k, f"{prose(25)} {passage} {prose(25)}") for k in range(5)]
    docs += [(1070, "a@b.c.d_x@y.z q@w@e.r x@y 1.2.3.4.5.6.7.8 300.1.1.1 4111 1111 1111 1111 4111  1111")]
    docs += [(1071, "é😀 a@b.co +1 (017) 555-7713 +12 +1(((( +1234567890123456 " + "1 " * 500), (1072, "1" * 3000)]
    return docs


def documents():
    return read("documents", ["doc_id", "text"]) + odd_documents()


def write_documents(spark, path, docs):
    rows = [(d, t, "en", "src0", len(t or ""), 5, 6, "b", "k", "r", "t", "l") for d, t in docs]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    spark.createDataFrame(rows, schema).coalesce(3).write.mode("overwrite").parquet(f"{path}/documents.parquet")


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, v) for v in r])
