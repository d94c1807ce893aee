"""U1 with a scorer outside Python: a child process that lives as long as its worker.

``external_scorer(command)`` is a plug-in factory (see ``neural``). Each Python worker starts the
command once and talks to it over pipes in frames of JSON lines: a line ``{"n": k}``, then k lines
``{"source", "reference", "hypothesis"}``; the child answers each frame with k lines that hold
``prediction``, in order, and flushes. A child that dies, answers with something else, or takes
longer than ``timeout`` seconds for a frame is ended and started again, and the frame, none of
whose answers were used, is sent again, up to ``restarts`` times in a row; then the task fails with
the end of the child's error output, and Spark repeats it elsewhere. So a segment has one
score, whatever happened on the way. An idle child sees the end of its input when the
worker goes, and should end then.
"""

from __future__ import annotations

import collections
import json
import os
import queue
import subprocess
import threading
from collections.abc import Callable, Sequence

STDERR_LINES = 40


class ScorerFailed(RuntimeError):
    """The child failed more often than it may."""


class ChildScorer:
    """A scorer (``neural.scored``) that asks a child process."""

    def __init__(self, command: Sequence[str], timeout: float, restarts: int, env: dict | None = None):
        self.command, self.timeout, self.restarts, self.env = list(command), timeout, restarts, env
        self.child: subprocess.Popen | None = None
        self.started = 0

    # ------------------------------------------------------------ the process
    def _start(self) -> None:
        self.started += 1
        self.child = subprocess.Popen(self.command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE,
                                      env={**os.environ, **(self.env or {})})
        self.lines: queue.Queue = queue.Queue()
        self.errors: collections.deque = collections.deque(maxlen=STDERR_LINES)
        for stream, put in ((self.child.stdout, self.lines.put), (self.child.stderr, self.errors.append)):
            threading.Thread(target=self._pump, args=(stream, put), daemon=True).start()

    @staticmethod
    def _pump(stream, put: Callable) -> None:
        for line in stream:
            put(line)
        put(None)

    def close(self) -> None:
        child, self.child = self.child, None
        if child is not None:
            child.kill()
            child.wait()
            for stream in (child.stdin, child.stdout, child.stderr):
                try:
                    stream.close()
                except OSError:
                    pass

    # ------------------------------------------------------------ frames
    def _ask(self, triples: list[dict]) -> list[float]:
        if self.child is None or self.child.poll() is not None:
            self.close()
            self._start()
        rows = [{"n": len(triples)}, *({"source": t["src"], "reference": t["ref"], "hypothesis": t["mt"]} for t in triples)]
        data = "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows).encode()
        sender = threading.Thread(target=self._send, args=(self.child, data), daemon=True)  # a child may answer before it has read all
        sender.start()
        out = []
        limit = threading.Event()
        timer = threading.Timer(self.timeout, lambda: (limit.set(), self.lines.put(None)))
        timer.daemon = True
        timer.start()
        try:
            while len(out) < len(triples):
                line = self.lines.get()
                if line is None:
                    raise ScorerFailed(f"no answer within {self.timeout} seconds" if limit.is_set() else "the scorer ended")
                out.append(float(json.loads(line)["prediction"]))
        except (ValueError, KeyError, TypeError) as e:
            raise ScorerFailed(f"an answer that isn't a prediction: {e!r}") from e
        finally:
            timer.cancel()
        sender.join()
        if not self.lines.empty():
            raise ScorerFailed("more answers than segments")
        return out

    @staticmethod
    def _send(child: subprocess.Popen, data: bytes) -> None:
        try:
            child.stdin.write(data)
            child.stdin.flush()
        except OSError:
            pass  # the reader sees that the child is gone

    def __call__(self, triples: list[dict]) -> list[float]:
        for left in range(self.restarts, -1, -1):
            try:
                return self._ask(triples)
            except (ScorerFailed, OSError) as e:
                said = b"".join(x for x in getattr(self, "errors", ()) if x).decode("utf-8", "replace")
                self.close()
                if not left:
                    raise ScorerFailed(f"{self.command[0]}: {e}\n{said}") from e
        return []


def external_scorer(command: Sequence[str], timeout: float = 600.0, restarts: int = 2, env: dict | None = None) -> Callable[[], ChildScorer]:
    """A factory for ``score_segments``, ``system_score``, ``metric_row`` and the back-fill."""
    command = tuple(command)
    return lambda: ChildScorer(command, timeout, restarts, env)
