import ipaddress
import random

from wirelake.functions.ip import ip_canonical

FIXED = [
    "::", "::1", "1::", ":::", "1::2::3", "::ffff:1.2.3.4", "::1.2.3.4", "1:2:3:4:5:6:7::",
    "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "fe80::1%eth0", "::1:2:", ":1::2",
    "", "::ffff:0:0", "::FFFF:102:304", "2001:DB8:0:0::1", "10:0:0:1:0:0:0:1", "::1.2.3.4:5",
    "::01.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "::1\n", "1.2.3.4\n", "1.2.3.4",
    " 1.2.3.4", "0.0.0.0", "255.255.255.255", "256.1.1.1", "01.2.3.4", "1:0:0:2:0:0:3:4",
    "0:0:1::", "1:0:0:0:2:0:0:0",
]


def _random_address(r):
    def group():
        return r.choice(["0", "0", "0", "0000", "1", "a", "0a0", "FFFF", "12345", "g", f"{r.randrange(65536):x}"])

    if r.random() < 0.3:
        return ".".join(r.choice(["0", "01", "256", str(r.randrange(256))]) for _ in range(r.choice([3, 4, 4, 4])))
    text = ":".join(group() for _ in range(r.choice([5, 6, 7, 8, 8, 8])))
    if r.random() < 0.5:
        i = r.randrange(len(text) + 1)
        text = text[:i] + "::" + text[i:]
    if r.random() < 0.2:
        text += f":{r.randrange(256)}.1.{r.randrange(300)}.2"
    return text


def _expected(text):
    try:
        return None if "%" in text else str(ipaddress.ip_address(text))
    except ValueError:
        return None


def test_same_as_the_standard_library(spark):
    r = random.Random(7)
    texts = set(FIXED) | {_random_address(r) for _ in range(8000)}
    rows = [(t, _expected(t)) for t in texts]
    assert sum(e is not None for _, e in rows) > 400
    df = spark.createDataFrame(rows, "text STRING, wanted STRING")
    wrong = df.withColumn("got", ip_canonical("text")).filter("NOT (wanted <=> got)")
    assert wrong.collect() == []
