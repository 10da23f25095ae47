"""Golden stay sequences: (time, {area: label in minutes}), None where nothing is asserted."""

L20 = (20,)
L3 = (20, 10, 5)


def _case(limits, text):
    rows = []
    for record in text.split(";"):
        time, labels = record.strip().split(" ", 1)
        pairs = dict(p.strip().split("=") for p in labels.split(","))
        rows.append((time, {a: None if v == "?" else int(v) for a, v in pairs.items()}))
    return limits, rows


# Times, areas and labels that must come out; the notation only serves reading.
CASES = {
    "1": _case(L20, "08:00 a1=0; 08:00 a1=0, a2=0; 08:00 a1=0, a2=0, a3=0"),
    "2": _case(L20, "08:00 a1=0; 08:17 a1=0; 08:27 a1=20; 08:37 a1=0; 08:57 a1=0"),
    "3": _case(L20, "08:00 a1=0; 08:17 a2=0; 08:27 a3=0; 08:37 a1=0; 08:57 a1=20"),
    "3-2": _case(L20, "08:00 a1=0; 08:07 a2=0; 08:17 a3=0; 08:27 a1=20; 08:57 a1=0; 09:00 a1=0"),
    "4": _case(L20, "08:00 a1=0; 08:17 a1=0, a2=0; 08:27 a1=20, a2=0; 08:37 a2=20, a3=0; 08:57 a2=20, a3=20; "
                    "08:58 a2=0, a3=20; 09:28 a2=0, a3=?"),
    "4-2": _case(L20, "08:00 a1=0; 08:20 a1=20, a2=0; 08:40 a1=20, a2=20; 09:00 a2=20, a3=0; 09:21 a1=0, a2=0, a3=20; "
                      "09:41 a1=20, a2=0, a3=0; 10:12 a1=0, a2=0, a3=0"),
    "5": _case(L20, "08:10 a1=0; 08:13 a1=0; 08:00 a1=0; 08:20 a1=20"),
    "5-2": _case(L20, "08:10 a1=0; 08:13 a1=0; 07:44 a1=20; 08:14 a1=0"),
    "6": _case(L20, "08:00 a1=0; 08:03 a1=0; 07:29 a1=0; 08:11 a1=0; 08:20 a1=20"),
    "7": _case(L20, "08:10 a1=0; 08:00 a1=0, a2=0; 08:17 a1=0, a2=0, a3=0; 08:20 a1=20, a2=20, a3=0; "
                    "08:27 a1=20, a2=20, a3=0"),
    "7-2": _case(L20, "08:10 a1=0; 08:40 a1=20, a2=0; 08:17 a1=0, a2=20, a3=0; 08:20 a1=0, a2=0, a3=0; "
                      "08:37 a1=0, a2=0, a3=20"),
    "8": _case(L20, "08:00 a1=0; 08:05 a1=0, a2=0; 07:34 a1=0, a2=0; 08:25 a1=20, a2=20, a3=?"),
    "9": _case(L20, "08:00 a1=0; 08:01 a2=0, a3=0; 08:20 a1=20; 08:30 a1=20; 08:31 a1=0, a2=20; 08:32 a3=0"),
    "10": _case(L3, "08:00 a1=0; 08:03 a1=0; 08:05 a1=5; 08:08 a1=5; 08:10 a1=10; 08:13 a1=10; 08:20 a1=20; 08:23 a1=20"),
    "11": _case(L3, "08:00 a1=0; 08:03 a1=0, a2=0; 08:05 a1=5, a2=?; 08:08 a2=5, a3=0; 08:10 a2=5, a3=0; "
                    "08:13 a2=10, a3=5; 08:20 a1=20, a2=10, a3=10; 08:23 a1=20, a2=20, a3=0; 08:28 a1=0, a2=20, a3=20"),
}

# 2015-04-01 00:00 UTC
MIDNIGHT = 1_427_846_400_000
MINUTE = 60_000


def millis(time: str) -> int:
    h, m = time.split(":")
    return MIDNIGHT + (int(h) * 60 + int(m)) * MINUTE
