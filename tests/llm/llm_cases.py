"""Rows that every operator of this folder has to take."""
import random

SF_CHECK = "/root/testdata/sf0.01"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n_words int, shard int, __range int, row string, words string, pos int, copies int, node long, quality int")


def edge_rows():
    """Null, empty, blank, short, very long, repeated and tied rows, and columns
    whose names the operators use themselves."""
    rng = random.Random(4)
    vocabulary = ["the", "of", "and", "Zu", "éàü", "don't", "x1", "!!", "naïve", "river", "stone", "walk", "blue"]
    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))
    long_text = "\n".join(prose(12) + str(i) for i in range(400)) + " " + "ab" * 20000
    tied = prose(30)
    texts = [(1, None), (2, ""), (3, "   \n\t \n"), (4, "a b"), (5, long_text), (6, long_text), (6, long_text),
             (7, tied), (8, tied), (9, tied + " more"), (None, "no number here at all, of the river"), (10, "line one here\nline one here"),
             (11, "<|endoftext|> is 's a'll  text  "), (12, "一二 ٣٤ \U0001f600 end")]
    texts += [(20 + i, prose(rng.randint(1, 60)) + ("\n" + prose(9)) * (i % 3)) for i in range(40)]
    return [(i, t, None if k % 7 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t),
             k, k, k, "r", "w", k, k, k, 1) for k, (i, t) in enumerate(texts)]


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
