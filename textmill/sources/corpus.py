"""Corpus readers and text preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

BLANKS = " \t\r\n\f\u000b"


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def corpus_lines(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, line_no, line): stripped non-blank lines of one-document rows."""
    lines = F.split(F.col(text), "\n")
    return (
        df.select(*keys, F.posexplode(lines).alias("line_no", "raw"))
        .select(*keys, "line_no", stripped(F.col("raw")).alias("line"))
        .filter(F.col("line") != "")
    )


def read_corpus_lines(spark: SparkSession, path: str, blanks_separate_docs: bool = True) -> DataFrame:
    """(doc_id, line_no, line) from text files where a blank line ends a document.

    Files are read in splits. Blank lines are counted inside each split and the split totals are summed up
    per file, so a huge file is never pulled into one task.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        stripped(F.col("value")).alias("line"),
    )
    blank = F.when(F.col("line") == "", 1).otherwise(0)
    inside = Window.partitionBy("file", "block").orderBy("at")
    totals = raw.groupBy("file", "block").agg(F.sum(blank).alias("blanks"), F.count("*").alias("rows"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "file", "block",
        F.coalesce(F.sum("blanks").over(ahead), F.lit(0)).alias("blank_base"),
        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("row_base"),
    )
    doc_no = (F.col("blank_base") + F.col("seen")) if blanks_separate_docs else F.lit(0)
    return (
        raw.withColumn("seen", F.sum(blank).over(inside))
        .withColumn("nth", F.row_number().over(inside) - 1)
        .join(bases, ["file", "block"])
        .filter(F.col("line") != "")
        .select(
            # The folder tells files of one name apart.
            F.concat_ws("#", F.substring_index("file", "/", -1), doc_no.cast("string"),
                        F.regexp_extract("file", "^(.*)/", 1)).alias("doc_id"),
            (F.col("row_base") + F.col("nth")).alias("line_no"), "line",
        )
    )


# The named entities that survive in page text, unescaped last to first so that an
# escaped ampersand does not create a new entity.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
PAGE_RULES = [
    (r"(?is)<!--.*?-->", " "),
    (r"(?is)<script[^>]*>.*?</script>", " "),
    (r"(?is)<style[^>]*>.*?</style>", " "),
    (r"(?is)<head[^>]*>.*?</head>", " "),
    (r"(?is)<nav[^>]*>.*?</nav>", " "),
    (r"(?is)<br\s*/?>|</?(p|div|h[1-6]|li|ul|ol|tr|td|th|table|article|section|footer|header)[^>]*>", "\n"),
    (r"(?is)<[^>]*>", ""),
]


def clean_pages(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(keys, text): text passages of raw pages, one per line; pages without text are dropped."""
    text = F.col(html)
    for pattern, to in PAGE_RULES:
        text = F.regexp_replace(text, pattern, to)
    for entity, to in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(to))
    text = F.regexp_replace(text, r"[ \t\r\f]+", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n")
    return pages.select(*keys, stripped(text).alias("text")).filter(F.col("text") != "")


def sentence_segment(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, sent_no, sentence): a sentence ends at . ! or ? before blank space."""
    parts = F.split(F.col(text), r"(?<=[.!?])\s+")
    return (
        df.select(*keys, F.posexplode(parts).alias("sent_no", "raw"))
        .select(*keys, "sent_no", stripped(F.col("raw")).alias("sentence"))
        .filter(F.col("sentence") != "")
    )


def merge_corpora(**parts: DataFrame) -> DataFrame:
    """Concatenate corpora of one schema, each row marked with its corpus name."""
    merged = None
    for name, df in parts.items():
        marked = df.withColumn("corpus", F.lit(name))
        merged = marked if merged is None else merged.unionByName(marked)
    return merged
