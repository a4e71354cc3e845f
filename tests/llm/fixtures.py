"""Small frames with the awkward cases every operator must take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string, segments string, offset int, cid string"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def long_text(n=3000, seed=1):
    out, x = [], seed
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x % len(WORDS)] + str(x % 997))
    return " ".join(out)


def texts():
    base = long_text(200, 7).split(" ")
    near = base[:]
    near[100] = "CHANGED"
    far = base[:60] + long_text(140, 11).split(" ")
    return [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(base).upper()), (5, None), (6, ""),
        (7, " \t\n "), (8, "one two"), (9, "one  two"), (10, "naïve café 😀 l’été"), (11, long_text(20000, 3)),
        (12, "x" * 30000), (None, "no key here at all, none"), (13, "one two"), (13, "one two"),
        (14, "mail a.b@c.de, call +1 (017) 555-7713, host 10.0.0.1, card 4111 1111 1111 1111"),
        (15, "Intro line\nReleased under the MIT License.\nOutro"), (16, "<|endoftext|> it's\r\n  here  \n"),
    ]


def docs(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t) if t is not None else None, "x", "y", 7, "z") for i, t in rows], DOCS
    )
