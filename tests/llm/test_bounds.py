"""Bounds that must not drop what matters: whole private keys, long names, one very long labelled document."""

import base64
import hashlib

import numpy as np
import pytest
from millrace.llm import secrets, toxicity


def key_lines(seed, n):
    return [base64.b64encode(hashlib.sha512(f"{seed}|{i}".encode()).digest() * 2).decode()[:64] for i in range(n)]


def test_private_keys_are_masked_whole(spark):
    hexa = [hashlib.md5(str(i).encode()).hexdigest() for i in range(40)]
    rows = [(i, f'set token = "{h}" here') for i, h in enumerate(hexa)] + [(100 + i, f"the commit {h} was good") for i, h in enumerate(hexa)]
    body = "\n".join(key_lines("a", 25))
    blocks = {
        900: f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----",
        901: f"-----BEGIN ENCRYPTED PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-256-CBC,00FF\n\n{body}\n-----END ENCRYPTED PRIVATE KEY-----",
        902: "-----BEGIN PRIVATE KEY-----\\n" + "\\n".join(key_lines("b", 3)) + "\\n-----END PRIVATE KEY-----",
        903: f"-----BEGIN EC PRIVATE KEY-----\n{body}",  # cut off
    }
    rows += [(i, f"see below\n{block}" + ("" if i == 903 else "\nand after - all of it --- stays")) for i, block in blocks.items()]
    rows += [(910, f"{blocks[900]}\nbetween\n{blocks[902]}\nend"), (911, "-----BEGIN PRIVATE KEY----- is how a key begins, as every reader knows")]
    docs = spark.createDataFrame([(i, t, "src") for i, t in rows], "doc_id long, text string, source string")
    found = secrets.scan(docs)
    masked = {r["doc_id"]: r["text"] for r in secrets.redact(docs, found).collect()}
    assert all(masked[i] == "see below\n<SECRET>\nand after - all of it --- stays" for i in (900, 901, 902))
    assert masked[903] == "see below\n<SECRET>" and masked[910] == "<SECRET>\nbetween\n<SECRET>\nend"
    assert masked[911] == "<SECRET> is how a key begins, as every reader knows"


def test_names_of_many_words(spark):
    hexa = [hashlib.md5(str(i).encode()).hexdigest() for i in range(40)]
    rows = [(i, f'set token = "{h}" here') for i, h in enumerate(hexa)] + [(100 + i, f"the commit {h} was good") for i, h in enumerate(hexa)]
    rows += [(900, "DB_PASSWORD_FOR_THE_PRODUCTION_CLUSTER=hunter2xyz"), (901, f"tokenForTheStagingEnvironmentOfTheShop = '{hexa[7][:24]}'")]
    found = secrets.candidates(spark.createDataFrame([(i, t, "src") for i, t in rows], "doc_id long, text string, source string")).collect()
    got = {r["id"]: r["value"] for r in found}
    assert got[900] == "hunter2xyz" and got[901] == hexa[7][:24]


def test_words_of_each_label_are_bounded_apart():
    sizes, labels = np.array([5, 900, 5, 5, 80, 5]), np.array([1, 0, 0, 1, 0, 0])
    assert toxicity.within(sizes, labels, 100).tolist() == [True, False, True, True, True, True]
    assert toxicity.within(sizes, labels, 7).tolist() == [True, False, True, False, False, False]
    assert toxicity.within(np.array([50, 40]), np.array([1, 1]), 10).tolist() == [False, True]
    assert toxicity.within(sizes, labels, 10**9).all()


def test_one_long_labelled_document_does_not_starve_the_field(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    long_text = "plain words of no harm at all " * 150_000
    more = spark.createDataFrame([(-1, long_text)], "doc_id long, text string")
    marked = labels.select("doc_id", "toxic").unionByName(spark.createDataFrame([(-1, 0)], "doc_id long, toxic int"))

    def rates(field):
        told = toxicity.score(docs, field).join(labels, "doc_id").select("toxic", "predicted").collect()
        return [np.mean([r["predicted"] == 1 for r in told if r["toxic"] == t]) for t in (1, 0)]

    (hit, false), (hit_alone, false_alone) = (rates(toxicity.fit(*tables)) for tables in ((docs.select("doc_id", "text").unionByName(more), marked), (docs, labels)))
    assert hit > 0.5 and hit >= hit_alone - 0.1 and false <= false_alone + 0.02


def test_bounds_of_the_model_are_parameters(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    assert len(toxicity.fit(docs, labels, max_features=5).hashes) == 5
    with pytest.raises(ValueError):
        toxicity.fit(docs, labels, max_features=1 << 17)
