"""Clashing columns in mixing, headers and advert blocks of pages, starts of token files."""

from aerolith.llm import mixing, wavelet, wrappers
from aerolith.llm.queries import tokenizer_path


def test_mixing_with_its_own_names(spark):
    rows = [(i, "w " * (i % 9), "en", "a" if i % 3 else None, 7.0, "x") for i in range(30)]
    plain = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(rows, plain + ", __mix_p double, __MIX__kept string")
    base = spark.createDataFrame([r[:4] for r in rows], plain)
    of = lambda df: {r.doc_id: (r.n_tokens, r.probability, r.kept)
                     for r in mixing.mix(df).collect()}
    assert of(docs) == of(base)
    assert {"__mix_p", "__MIX__kept"} <= set(mixing.mix(docs).columns)
    left = mixing.sampled(docs)
    assert left.columns == docs.columns and all(r["__mix_p"] == 7.0 for r in left.collect())


def test_headers_and_advert_blocks():
    text = "Words of the page's own text that are many enough"
    no_article = (f"<html><body><header><h2>Site</h2></header><div id=x><p>{text}</p>"
                  f"<p class='advert'>Buy<br>now</p><p>{text}</p></div></body></html>")
    assert wrappers.extract(no_article, None, frozenset()) == f"{text} {text}"
    article = (f"<body><header>Site</header><article><header><h1 class=header>Head</h1></header>"
               f"<p>{text}</p><p class=sponsored-note id=p1>Buy</p>tail<p class=load>{text}</p>"
               "</article></body>")
    assert wrappers.extract(article, None, frozenset()) == f"Head {text} tail {text}"


def test_starts_of_many_files(spark):
    rows = [(i, "alpha beta gamma " * (1 + i % 5)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted(wavelet.token_files(docs, tokenizer_path(), shard_tokens=40).collect())
    assert len({r.file for r in got}) > 6
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
