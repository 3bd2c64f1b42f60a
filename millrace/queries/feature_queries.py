"""Feature transformers."""

from __future__ import annotations

from pyspark.ml.feature import (
    IDF,
    PCA,
    Binarizer,
    Bucketizer,
    ElementwiseProduct,
    HashingTF,
    IndexToString,
    NGram,
    Normalizer,
    OneHotEncoder,
    PolynomialExpansion,
    RegexTokenizer,
    RFormula,
    SQLTransformer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
    VectorIndexer,
    Word2Vec,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.ml.nearest import nearest, nearest_words
from millrace.ml.text import tf_idf
from millrace.queries.aggregates import embedding_vectors
from millrace.registry import query
from millrace.session import table

LINE = ["l_orderkey", "l_linenumber"]


def line_vectors(spark, sf_dir, columns=("l_quantity", "l_extendedprice", "l_discount")):
    lines = table(spark, sf_dir, "lineitem").select(*dict.fromkeys([*LINE, *columns]))
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(lines)


def unpacked(df, column, names, keys=LINE, digits=None):
    """A vector column as one double column per position."""
    values = df.select(*keys, vector_to_array(column).alias("__v"))
    pick = lambda i: F.element_at("__v", i + 1)
    return values.select(*keys, *[(F.round(pick(i), digits) if digits else pick(i)).alias(n) for i, n in enumerate(names)])


@query(
    "ml_binarizer",
    "select l_orderkey, l_linenumber, l_discount, case when l_discount > 0.05 then 1.0::double else 0.0::double end as high from lineitem",
)
def ml_binarizer(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE, "l_discount")
    return Binarizer(threshold=0.05, inputCol="l_discount", outputCol="high").transform(lines)


@query(
    "ml_bucketizer",
    """select event_id, case when value < 50 then 0.0 when value < 100 then 1.0 when value < 200 then 2.0 else 3.0 end::double as bucket
       from events""",
)
def ml_bucketizer(spark, sf_dir):
    splits = [float("-inf"), 50.0, 100.0, 200.0, float("inf")]
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return Bucketizer(splits=splits, inputCol="value", outputCol="bucket").transform(events).select("event_id", "bucket")


@query(
    "ml_elementwise",
    "select l_orderkey, l_linenumber, l_quantity * 0 as a, l_extendedprice * 1 as b, l_discount * 2 as c from lineitem",
)
def ml_elementwise(spark, sf_dir):
    scaler = ElementwiseProduct(scalingVec=Vectors.dense([0.0, 1.0, 2.0]), inputCol="features", outputCol="scaled")
    return unpacked(scaler.transform(line_vectors(spark, sf_dir)), "scaled", ["a", "b", "c"])


@query(
    "ml_normalizer",
    """select l_orderkey, l_linenumber, round(l_quantity / s, 9) as a1, round(l_extendedprice / s, 9) as b1,
              round(l_quantity / m, 9) as am, round(l_extendedprice / m, 9) as bm
       from (select *, abs(l_quantity) + abs(l_extendedprice) + abs(l_discount) as s,
                    greatest(abs(l_quantity), abs(l_extendedprice), abs(l_discount)) as m from lineitem)""",
)
def ml_normalizer(spark, sf_dir):
    normalizer = Normalizer(inputCol="features", outputCol="l1", p=1.0)
    both = normalizer.transform(line_vectors(spark, sf_dir))
    both = normalizer.transform(both, {normalizer.p: float("inf"), normalizer.outputCol: "lmax"})
    a, b = vector_to_array("l1"), vector_to_array("lmax")
    return both.select(
        *LINE,
        F.round(a[0], 9).alias("a1"),
        F.round(a[1], 9).alias("b1"),
        F.round(b[0], 9).alias("am"),
        F.round(b[1], 9).alias("bm"),
    )


@query(
    "ml_standard_scaler",
    """select l_orderkey, l_linenumber, round(l_quantity / (select stddev_samp(l_quantity) from lineitem), 6) as a,
              round(l_extendedprice / (select stddev_samp(l_extendedprice) from lineitem), 6) as b,
              round(l_discount / (select stddev_samp(l_discount) from lineitem), 6) as c from lineitem""",
)
def ml_standard_scaler(spark, sf_dir):
    vectors = line_vectors(spark, sf_dir)
    model = StandardScaler(inputCol="features", outputCol="scaled", withStd=True, withMean=False).fit(vectors)
    return unpacked(model.transform(vectors), "scaled", ["a", "b", "c"], digits=6)


BRAND_INDEX = """(select p_brand, (row_number() over (order by count(*) desc, p_brand) - 1)::double as idx from part group by p_brand)"""


@query("ml_string_indexer", f"select p_partkey, p.p_brand, idx from part p join {BRAND_INDEX} b on p.p_brand = b.p_brand")
def ml_string_indexer(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return StringIndexer(inputCol="p_brand", outputCol="idx").fit(parts).transform(parts)


@query("ml_index_to_string", f"select p_partkey, idx, p.p_brand as brand from part p join {BRAND_INDEX} b on p.p_brand = b.p_brand")
def ml_index_to_string(spark, sf_dir):
    indexed = ml_string_indexer(spark, sf_dir)
    return IndexToString(inputCol="idx", outputCol="brand").transform(indexed).select("p_partkey", "idx", "brand")


@query(
    "ml_one_hot",
    f"""select p_partkey, (select count(distinct p_brand) from part) as width, idx::integer as one
        from part p join {BRAND_INDEX} b on p.p_brand = b.p_brand""",
)
def ml_one_hot(spark, sf_dir):
    indexed = ml_string_indexer(spark, sf_dir)
    encoder = OneHotEncoder(inputCol="idx", outputCol="encoded", dropLast=False).fit(indexed)
    values = encoder.transform(indexed).select("p_partkey", vector_to_array("encoded").alias("v"))
    position = (F.array_position("v", 1.0) - 1).cast("int")
    return values.select("p_partkey", F.size("v").cast("bigint").alias("width"), position.alias("one"))


@query(
    "ml_vector_indexer",
    """select l_orderkey, l_linenumber, (dense_rank() over (order by l_linenumber) - 1)::double as a,
              (dense_rank() over (order by l_tax) - 1)::double as b, l_quantity as c from lineitem""",
)
def ml_vector_indexer(spark, sf_dir):
    vectors = line_vectors(spark, sf_dir, ("l_linenumber", "l_tax", "l_quantity"))
    model = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=10).fit(vectors)
    return unpacked(model.transform(vectors), "indexed", ["a", "b", "c"])


@query(
    "ml_vector_assembler",
    "select l_orderkey, l_linenumber, l_quantity as a, l_tax as b, l_quantity as c, l_discount as d from lineitem",
)
def ml_vector_assembler(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE, "l_quantity", "l_discount", "l_tax")
    inner = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="pair").transform(lines)
    whole = VectorAssembler(inputCols=["l_quantity", "l_tax", "pair"], outputCol="features").transform(inner)
    return unpacked(whole, "features", ["a", "b", "c", "d"])


@query(
    "ml_polynomial",
    """select l_orderkey, l_linenumber, l_quantity as x, round(l_quantity * l_quantity, 6) as xx, l_discount as y,
              round(l_quantity * l_discount, 6) as xy, round(l_discount * l_discount, 6) as yy from lineitem""",
)
def ml_polynomial(spark, sf_dir):
    vectors = line_vectors(spark, sf_dir, ("l_quantity", "l_discount"))
    expanded = PolynomialExpansion(degree=2, inputCol="features", outputCol="poly").transform(vectors)
    return unpacked(expanded, "poly", ["x", "xx", "y", "xy", "yy"], digits=6)


@query("ml_pca")
def ml_pca(spark, sf_dir):
    vectors = embedding_vectors(spark, sf_dir)
    model = PCA(k=3, inputCol="features", outputCol="pca").fit(vectors)
    return unpacked(model.transform(vectors), "pca", ["pc1", "pc2", "pc3"], keys=["vec_id"])


@query(
    "ml_rformula",
    """with f as (select o_orderpriority as p, row_number() over (order by count(*) desc, o_orderpriority) as rn from orders group by 1)
       select o_orderkey, case when o_orderstatus = 'F' then 1.0::double else 0.0::double end as label,
              case when rn = 1 then 1.0::double else 0.0::double end as d1, case when rn = 2 then 1.0::double else 0.0::double end as d2,
              case when rn = 3 then 1.0::double else 0.0::double end as d3, case when rn = 4 then 1.0::double else 0.0::double end as d4,
              o_totalprice as price from orders join f on o_orderpriority = p""",
)
def ml_rformula(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("double").alias("done"), "o_orderpriority", "o_totalprice"
    )
    model = RFormula(formula="done ~ o_orderpriority + o_totalprice", featuresCol="features", labelCol="label").fit(orders)
    return unpacked(model.transform(orders), "features", ["d1", "d2", "d3", "d4", "price"], keys=["o_orderkey", "label"])


@query(
    "ml_sql_transformer",
    "select l_orderkey, l_quantity + l_tax as v3, l_quantity * l_tax as v4 from lineitem",
)
def ml_sql_transformer(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").alias("v1"), F.col("l_tax").alias("v2"))
    statement = "SELECT *, (v1 + v2) AS v3, (v1 * v2) AS v4 FROM __THIS__"
    return SQLTransformer(statement=statement).transform(lines).select("l_orderkey", "v3", "v4")


def token_rows(df, column="tokens"):
    """Per document the number of tokens and a digest of them in order."""
    return df.select(
        "doc_id", F.size(column).cast("bigint").alias("n"), F.md5(F.array_join(column, "|")).alias("digest")
    )


def tokens_of(documents):
    return Tokenizer(inputCol="text", outputCol="tokens").transform(documents)


def tokenized(spark, sf_dir):
    return tokens_of(table(spark, sf_dir, "documents").select("doc_id", "text"))


TOKENS = r"string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s')"


def _digest_sql(tokens: str) -> str:
    return f"select doc_id, len(t) as n, md5(array_to_string(t, '|')) as digest from (select doc_id, {tokens} as t from documents)"


@query("ml_tokenizer", _digest_sql(TOKENS))
def ml_tokenizer(spark, sf_dir):
    return token_rows(tokenized(spark, sf_dir))


@query("ml_regex_tokenizer", _digest_sql(r"list_filter(string_split_regex(lower(text), '\W'), lambda x: x <> '')"))
def ml_regex_tokenizer(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_rows(RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"\W").transform(documents))


#: The English stop words of the remover's default, given to it and to the SQL alike. Fixed values.
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves", "he", "him", "his",
    "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at",
    "by", "for", "with", "about", "against", "between", "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so",
    "than", "too", "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll",
    "they'll", "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've",
    "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's", "ought",
    "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]


def _stop_sql() -> str:
    quoted = ", ".join("'" + w.lower().replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)
    return _digest_sql(f"list_filter({TOKENS}, lambda x: not list_contains([{quoted}], x))")


@query("ml_stopwords", _stop_sql())
def ml_stopwords(spark, sf_dir):
    remover = StopWordsRemover(inputCol="tokens", outputCol="kept", stopWords=ENGLISH_STOP_WORDS)
    return token_rows(remover.transform(tokenized(spark, sf_dir)), "kept")


@query(
    "ml_ngram",
    f"""select doc_id, len(g) as n, md5(array_to_string(g, '|')) as digest from (
          select doc_id, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) as g from
            (select doc_id, {TOKENS} as t from documents))""",
)
def ml_ngram(spark, sf_dir):
    return token_rows(NGram(n=2, inputCol="tokens", outputCol="grams").transform(tokenized(spark, sf_dir)), "grams")


@query(
    "ml_tf_idf",
    f"""with w as (select doc_id, unnest({TOKENS}) as word from documents),
        tf as (select doc_id, word, count(*) as tf from w group by 1, 2), df as (select word, count(*) as df from tf group by 1)
        select doc_id, count(*) as terms, round(sum(tf * ln(((select count(*) from documents) + 1) / (df + 1))), 4) as weight,
               round(max(tf * ln(((select count(*) from documents) + 1) / (df + 1))), 6) as top_weight
        from tf join df on tf.word = df.word group by doc_id""",
)
def ml_tf_idf(spark, sf_dir):
    # whole texts meet by document, so that their words are counted where they are; the outer form spares Spark's inferred filter on the list, which would tokenize every text again
    texts = table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")
    words = tokens_of(texts).select("doc_id", F.explode_outer("tokens").alias("word")).filter("word is not null")
    return tf_idf(words, table(spark, sf_dir, "documents").count()).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("terms"), F.round(F.sum("weight"), 4).alias("weight"), F.round(F.max("weight"), 6).alias("top_weight")
    )


@query("ml_tf_idf_hashed")
def ml_tf_idf_hashed(spark, sf_dir):
    counted = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=20).transform(tokenized(spark, sf_dir))
    weighted = IDF(inputCol="tf", outputCol="weights").fit(counted).transform(counted)
    return unpacked(weighted, "weights", [f"w{i}" for i in range(20)], keys=["doc_id"])


def document_words(spark, sf_dir):
    """The word vectors of all documents, and the words they come from."""
    # every word counts, so the vocabulary is the driver's model state; the number of partitions is part of the result and fixed
    words = tokenized(spark, sf_dir)
    return Word2Vec(vectorSize=3, minCount=0, seed=42, maxIter=1, numPartitions=4, inputCol="tokens", outputCol="v").fit(words), words


@query("ml_word2vec")
def ml_word2vec(spark, sf_dir):
    model, words = document_words(spark, sf_dir)
    return unpacked(model.transform(words), "v", ["v0", "v1", "v2"], keys=["doc_id"])


@query("ml_word2vec_nearest")
def ml_word2vec_nearest(spark, sf_dir):
    # the nearest 40 words of every word of the benchmark that the documents have
    asked = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), r"\s+")).alias("word"))
    return nearest_words(document_words(spark, sf_dir)[0], asked)


NEAREST_SQL = """
with v as (select vec_id, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as length from embeddings),
pairs as (select a.vec_id as asked, b.vec_id as id, round(list_dot_product(list_transform(a.e, lambda x: x / a.length), list_transform(b.e, lambda x: x / b.length)), 9) as similarity
          from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0)
select asked, rank::integer as rank, id from (select *, row_number() over (partition by asked order by similarity desc, id) as rank from pairs) where rank <= 40"""


@query("ml_nearest_vectors", NEAREST_SQL)
def ml_nearest_vectors(spark, sf_dir):
    # the questions are every twentieth vector, the answers come from all
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return nearest(vectors, vectors.filter("id % 20 = 0"), 40).drop("similarity")
