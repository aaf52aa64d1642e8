"""Rows with every oddity."""

LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(30_000))
STORY = " ".join(f"{a}{b}" for a in ("sun", "moon", "star", "rain", "wind") for b in ("rise", "set", "fall", "glow", "song", "tide", "mist", "dust", "leaf", "path", "gate", "lake", "road", "hill"))
ROWS = [
    (1, STORY, "en", "a"),
    (2, STORY, "en", "a"),
    (2, STORY, "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, " \t\n\x0b ", "de", "b"),
    (6, "one", "de", "b"),
    (None, "no id but ten words are here so that it counts", "de", "b"),
    (7, LONG, "fr", "c"),
    (8, "prefix of its own " + STORY + " and a tail that is new", "en", "a"),
    (9, "Größe naïve 日本語 😀 end of text\nline\nline\nline", "fr", "c"),
    (9, "same id another text\r\nwith two lines", None, None),
]
