"""The stateful rules row by row: what one key's state does with the next row in time order.

Each rule works on a plain dict, so the same few lines drive the stream processor and serve as the model the closed
batch forms are tested against. Times are microseconds.
"""

from __future__ import annotations

from eventmart.operators.credits import INSUFFICIENT
from eventmart.operators.media import INTERNAL_ERROR, NOT_FOUND
from eventmart.operators.sagas import MAX_RETRIES, MOVE_TIMEOUT_S, UPLOAD_TTL_S

SECOND = 1_000_000


class UploadTtl:
    """Signed (kind 0) and received (kind 1) rows of one file path."""

    state = ("deadline long, completed boolean, user_id string, file_name string, request_id string, "
             "signed_time string, receipt long")

    def __init__(self, ttl_s: int = UPLOAD_TTL_S):
        self.ttl = ttl_s * SECOND

    def order(self, row: dict):
        return row["us"], row["kind"], row["request_id"] or ""

    def wake_at(self, state: dict) -> int | None:
        """When state must be looked at again: at the deadline, or when a remembered receipt is of no more use."""
        if state.get("deadline") is not None:
            return state["deadline"]
        return None if state.get("receipt") is None else state["receipt"] + self.ttl

    def settle(self, state: dict, us: int) -> list[dict]:
        """Close what ended before `us`."""
        wake = self.wake_at(state)
        if wake is None or us <= wake:
            return []
        out = []
        if state.get("deadline") is not None and not state["completed"]:
            out.append({"outcome_us": state["deadline"], **{k: state[k] for k in
                        ("user_id", "file_name", "request_id", "signed_time")}})
        state.clear()
        return out

    def step(self, state: dict, row: dict) -> list[dict]:
        out = self.settle(state, row["us"])
        active = state.get("deadline") is not None
        if row["kind"] == 1:
            if active:
                state["completed"] = True
            else:
                state["receipt"] = row["us"]
        else:
            # A receipt still remembered here is recent enough to count: settle dropped older ones.
            completed = state["completed"] if active else state.get("receipt") is not None
            state.update(deadline=row["us"] + self.ttl, completed=completed, receipt=None,
                         **{k: row[k] for k in ("user_id", "file_name", "request_id", "signed_time")})
        return out


class MoveSaga:
    """Received (kind 0) and ready (kind 1) rows of one permanent path."""

    fields = ["user_id", "email", "file_path", "file_name", "file_size", "media_type", "upload_time", "retry_count"]
    state = ("open_kind int, open_us long, user_id string, email string, file_path string, file_name string, "
             "file_size long, media_type string, upload_time string, retry_count int")

    def __init__(self, timeout_s: int = MOVE_TIMEOUT_S, max_retries: int = MAX_RETRIES):
        self.limit, self.max_retries = timeout_s * SECOND, max_retries

    def order(self, row: dict):
        return row["us"], row["kind"], row["retry_count"] if row["retry_count"] is not None else -1

    def wake_at(self, state: dict) -> int | None:
        return None if state.get("open_us") is None else state["open_us"] + self.limit

    def settle(self, state: dict, us: int) -> list[dict]:
        wake = self.wake_at(state)
        if wake is None or us <= wake:
            return []
        out = []
        if state["open_kind"] == 0:
            kind = "retry" if state["retry_count"] < self.max_retries else "dead_letter"
            out.append(self._outcome(kind, wake, state))
        state.clear()
        return out

    def step(self, state: dict, row: dict) -> list[dict]:
        out = self.settle(state, row["us"])
        if state.get("open_us") is not None and state["open_kind"] != row["kind"]:
            out.append(self._outcome("confirmed", row["us"], row if row["kind"] == 0 else state))
            state.clear()
        else:
            state.update(open_kind=row["kind"], open_us=row["us"], **{k: row[k] for k in self.fields})
        return out

    def _outcome(self, kind: str, us: int, row: dict) -> dict:
        return {"_type": kind, "outcome_us": us, **{k: row[k] for k in self.fields}}


class CreditCheck:
    """Credits (kind 0) and upload intents (kind 1) of one user."""

    fields = ["file_name", "media_type", "file_size", "request_id", "request_time"]
    state = "balance long"

    def order(self, row: dict):
        return row["us"], row["kind"], row["request_id"] or ""

    def wake_at(self, state: dict) -> int | None:
        return None

    def settle(self, state: dict, us: int) -> list[dict]:
        return []

    def step(self, state: dict, row: dict) -> list[dict]:
        balance = state.get("balance") or 0
        if row["kind"] == 0:
            state["balance"] = max(0, balance + row["amount"])
            return []
        approved = balance >= 1
        state["balance"] = balance - 1 if approved else balance
        reason = "" if approved else INSUFFICIENT
        return [{"outcome": "approved" if approved else "rejected", "reason": reason, "outcome_us": row["us"],
                 "ledger_delta": -1 if approved else 0, **{k: row[k] for k in self.fields}}]


class FileStore:
    """Confirmations (kind 0), delete (kind 1) and download (kind 2) intents of one owner's file."""

    state = "active boolean, confirmed_us long, deleted_us long, file_name string, media_type string, file_size long"
    metadata = ["file_name", "media_type", "file_size"]
    once = ("kind", "request_id")

    def __init__(self, remember_s: int = 86_400):
        self.remember_us = remember_s * SECOND

    def order(self, row: dict):
        return row["us"], row["kind"], row["request_id"] or "", tuple((row[m] is not None, row[m] or 0) if m == "file_size"
                                                                      else (row[m] is not None, row[m] or "") for m in self.metadata)

    def wake_at(self, state: dict) -> int | None:
        return None

    def settle(self, state: dict, us: int) -> list[dict]:
        return []

    def step(self, state: dict, row: dict) -> list[dict]:
        if row["kind"] == 0:
            # one that is older than what is known is a replay
            if row["us"] >= state.get("confirmed_us", row["us"]) and row["us"] > state.get("deleted_us", row["us"] - 1):
                state.update(active=True, confirmed_us=row["us"], **{m: row[m] for m in self.metadata})
            return []
        found = state.get("active", False)
        if row["kind"] == 2:
            if found and row["download_url"] is not None:
                return [self._outcome("signed", row, state, download_url=row["download_url"])]
            return [self._outcome("download_rejected", row, reason=INTERNAL_ERROR if found else NOT_FOUND)]
        if not found or not row["deleted_ok"]:
            return [self._outcome("delete_rejected", row, reason=INTERNAL_ERROR if found else NOT_FOUND)]
        state.update(active=False, deleted_us=row["us"])
        done = [self._outcome("deleted", row, state)]
        return done if row["removed_ok"] else done + [self._outcome("retry", row, state, retry_count=0)]

    def _outcome(self, outcome: str, row: dict, file: dict | None = None, **more) -> dict:
        return {"outcome": outcome, "request_id": row["request_id"], "outcome_time": row["request_time"], "download_url": None,
                "reason": None, "retry_count": None, **{m: (file or {}).get(m) for m in self.metadata}, **more}


class Lasting:
    """Points of one series, each with the start of the unbroken run of holding points it belongs to."""

    state = "since long, last long"

    def __init__(self, for_s: int, max_gap_s: int = 300):
        self.lasts, self.max_gap = for_s * SECOND, max_gap_s * SECOND

    def order(self, row: dict):
        return row["us"], row["holds"]

    def wake_at(self, state: dict) -> int | None:
        return state["last"] + self.max_gap

    def settle(self, state: dict, us: int) -> list[dict]:
        """A run ends when no point came for the longest gap."""
        if state and us > self.wake_at(state):
            state.clear()
        return []

    def step(self, state: dict, row: dict) -> list[dict]:
        us = row["us"]
        self.settle(state, us)
        if row["holds"]:
            state.update(since=state.get("since", us), last=us)
        else:
            state.clear()
        since = state.get("since")
        return [{"us": us, "since": since, "firing": since is not None and us - since >= self.lasts}]
