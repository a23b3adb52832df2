"""op6: literals with escapes, without a length limit, with spaces, and over several lines."""

import random
import string

import pytest

from tidemark.llm import secrets

LONG = "".join(random.Random(2).choices(string.ascii_letters + string.digits + "+/", k=4400))
BODY = "\n".join(LONG[i : i + 64] for i in range(0, 320, 64))
PEM = f"-----BEGIN PRIVATE KEY-----\n{BODY}\n-----END PRIVATE KEY-----"


@pytest.mark.parametrize(
    "before, value, after",
    [
        ('"private_key": "', PEM.replace("\n", "\\n"), '"'),
        ('credential = "', LONG, '"'),
        ("credential: ", LONG, ""),
        ('passphrase = "', "Correct horse 7 battery staple", '"'),
        ('signing_key = """', PEM, '"""'),
        ("credential = '''", BODY, "'''"),
        ("private_key: |\n", "  " + PEM.replace("\n", "\n  "), "\nother: 1"),
        ("private_key = ", PEM, ""),
        ('credential = "', 'aB3$\\"xY9 z!kQ', '"'),
    ],
)
def test_whole_literal_is_masked(before, value, after):
    text = f"a: 1\n{before}{value}{after}\nend\n"
    assert secrets.masked(text, secrets.spans(text)) == f"a: 1\n{before}<secret>{after}\nend\n"


def test_open_quotes_are_linear():
    text = 'key = "' + "a\\" * 200_000 + "\n" + 'k = """x\n' * 300
    assert secrets.spans(text) is not None


def found_values(text):
    return {text[s[3] : s[2]] for s in secrets.spans(text)}


@pytest.mark.parametrize(
    "text",
    [
        'password, other = "k9Xz81LmQ2vT7pWd", 1',
        "<password>k9Xz81LmQ2vT7pWd</password>",
        'db_password = prefix + "k9Xz81LmQ2vT7pWd"',
        'a = "k9Xz81LmQ2vT7pWd"\nuser, pwd = "me", a',
        'half = "k9Xz81LmQ2vT7pWd"\ndb_secret = half + tail',
        f'{"a" * 300}_password = "k9Xz81LmQ2vT7pWd"',
    ],
)
def test_tuples_tags_and_joined_literals(text):
    assert any("k9Xz81LmQ2vT7pWd" in v for v in found_values(text))
    assert "k9Xz81LmQ2vT7pWd" not in secrets.masked(text, secrets.spans(text))


def slow_reach(aliases):
    out = {}
    for name in aliases:
        reached, ahead = set(), [name]
        while ahead:
            for other in aliases.get(ahead.pop(), ()):
                if other not in reached:
                    reached.add(other)
                    ahead.append(other.lower())
        best = [t for t in sorted(reached, key=lambda t: (-secrets.sensitivity(t), t)) if secrets.sensitivity(t)]
        if best:
            out[name] = best[0]
    return out


def test_reachable_names_against_a_walk_from_each():
    import random

    rng = random.Random(2)
    names = ["a", "b", "c", "D", "password", "Token", "key", "pin", "e", "f"]
    for _ in range(300):
        aliases = {}
        for _ in range(rng.randrange(1, 14)):
            aliases.setdefault(rng.choice(names).lower(), set()).add(rng.choice(names))
        assert secrets.reachable(aliases) == slow_reach(aliases)


@pytest.mark.parametrize(
    "text",
    [
        "\n".join(f"a{i} = a{i + 1}" for i in range(40_000)) + '\na40000 = "k9Xz81LmQ2vT7pWd"\npassword = a0',
        "\n".join(f"a{i + 1} = a{i}" for i in range(40_000)) + '\na0 = "k9Xz81LmQ2vT7pWd"\npassword = a40000',
        "key: -----BEGIN X-----\n" * 40_000,
        "<password>" * 40_000,
        "a, " * 60_000 + "\n" + "b, " * 60_000 + "= 1",
        "x." * 200_000,
        'p = "a" ' + '+ "b" ' * 60_000,
    ],
)
def test_long_configuration_is_linear(text):
    import time

    start = time.process_time()
    secrets.spans(text)
    assert time.process_time() - start < 2
