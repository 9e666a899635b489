"""Small tables for the operators' tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


#: Nulls, empty and blank texts, odd characters, repeats, a long word and a long text.
ODD = [None, "", "   \n\t", "a", "A b", "x" * 5000, "one two three four five six seven eight nine ten " * 40, "Ünïcode … 中文 \x07 \x1c é İ", "<|endoftext|> and <|startoftext|>", "same text here", "same text here", "tab\tnew\nline\r\x0bfeed\x0c."]
