"""A small table with everything that can go wrong in a row."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _k1 string, _row long, "
          "size string, f string, `Added` string, `odd name` string")
LINE = "This very line is shared by many of the documents here, on purpose."
LONG = " ".join(f"word{i % 977}x{i}" for i in range(20_000))


def rows():
    texts = [None, "", "   ", "\n\n", "!!! ???", "short", LONG, LINE, f"  {LINE.upper()}\t\nown text of nine",
             f"{LINE}\n{LINE}\nalpha beta gamma delta epsilon", f"{LINE}\nzeta eta theta iota kappa lambda",
             f"one more\n{LINE}", "mail bob.smith@mail.example.com or call +1 (319) 555-5132 now", "é" * 500, "\x00 nul"]
    out = [(i, t, "en", f"s{i % 3}", len(t or ""), "key", 7, "big", "f", "a", "o") for i, t in enumerate(texts)]
    out += [out[9], out[9], out[6]]                                            # repeated rows
    out += [(None, "no id " + LINE, None, None, None, None, None, None, None, None, None),
            (None, None, None, None, None, None, None, None, None, None, None),
            (9, "the same id, another text", "de", None, 1, "x", 1, "y", "z", "b", "p")]
    return out


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
