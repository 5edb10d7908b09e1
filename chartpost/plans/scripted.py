"""A scripted endpoint: answers follow from the request id, so results can be predicted."""

from __future__ import annotations

from collections import Counter

from chartpost.operators.delivery import OpenTransport, Send


def scripted_transport(first_attempt: int = 0) -> OpenTransport:
    """Accepts by integer rule on (leading hex digits of the request id, attempt number).

    ``first_attempt`` continues the numbering where an earlier run stopped.
    """

    def open_transport() -> Send:
        calls: Counter[str] = Counter()

        def send(url: str, headers: dict[str, str], body: str) -> tuple[int, str]:
            request_id = headers["X-Request-Id"]
            attempt = first_attempt + calls[request_id]
            calls[request_id] += 1
            h = int(request_id[:4], 16)
            if h % 11 != 0 and (h * 31 + attempt * 17) % 10 < 6:
                return 201, f'{{"id":"r-{request_id[:12]}"}}'
            return 503, f"busy {h % 7}"

        return send

    return open_transport


def scripted_answer(status: int) -> OpenTransport:
    """The same status to every request, with an id."""

    def open_transport() -> Send:
        return lambda url, headers, body: (status, f'{{"id":"r-{headers["X-Request-Id"][:12]}"}}')

    return open_transport


def scripted_patients() -> OpenTransport:
    """Conditional creates: some refused for good, some patients there before, others made, late."""

    def open_transport() -> Send:
        calls: Counter[str] = Counter()

        def send(url: str, headers: dict[str, str], body: str) -> tuple[int, str]:
            request_id = headers["X-Request-Id"]
            attempt = calls[request_id]
            calls[request_id] += 1
            h = int(request_id[:4], 16)
            if h % 7 == 0 or (h + attempt) % 3 == 0:
                return 503, f"busy {h % 5}"
            patient = headers["If-None-Exist"].rpartition("|")[2]
            return 200 if h % 4 == 0 else 201, f'{{"resourceType":"Patient","id":"fhir-{patient}"}}'

        return send

    return open_transport
