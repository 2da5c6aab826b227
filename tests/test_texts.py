"""Texts for runs: all different, each long enough to sample from."""

NAMES = "cat dog hen cow fox owl bee ant".split()


def sentences_of(i):
    return " ".join(f"Here the {w} number {i} walks along a quiet road at hour {k} today." for k, w in enumerate(NAMES))


def test_texts_differ():
    assert len({sentences_of(i) for i in range(50)}) == 50


def bars(text):
    return text.split("|")


def by_dots(text):
    return [f"{s.strip()}." for s in text.split(".") if s.strip()]
