"""A client of the archive source for tests: 250 posts a community, three in each second."""


class TooFast(Exception):
    retry_after = 0


def client():
    calls = []

    def fetch(sub, kind, after, before, limit):
        calls.append(after)
        if len(calls) == 1:
            raise TooFast
        records = [{"id": f"{sub}{i}", "subreddit": sub, "created_utc": 1000 + i // 3} for i in range(250)]
        return [r for r in records if after <= r["created_utc"] < before][:limit]

    return fetch
