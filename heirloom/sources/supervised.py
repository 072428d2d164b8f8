"""Calls in child processes with a deadline, several at once."""

from __future__ import annotations

import multiprocessing
import os
import signal
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from multiprocessing.connection import Connection, wait

#: Seconds that a child has to end by itself after it was asked to.
GRACE = 2.0

Outcome = tuple[bool, str | None, float]


def _child(call: Callable[..., None], args: tuple, answer: Connection) -> None:
    os.setsid()  # what the call starts belongs to the child's group and ends with it
    try:
        call(*args)
    except Exception as e:  # noqa: BLE001  the answer carries the failure
        answer.send(str(e) or type(e).__name__)
    else:
        answer.send(None)
    answer.close()


def _signal(child: multiprocessing.Process, what: signal.Signals) -> None:
    try:
        os.killpg(child.pid, what)
    except ProcessLookupError:  # no group yet, or no child any more
        if child.is_alive():
            os.kill(child.pid, what)


def _end(child: multiprocessing.Process) -> None:
    """Ask the child's group to end, then kill it."""
    _signal(child, signal.SIGTERM)
    child.join(GRACE)
    _signal(child, signal.SIGKILL)
    child.join()


def each(call: Callable[..., None], tasks: Iterable[tuple], seconds: float, at_once: int = 4) -> Iterator[Outcome]:
    """``(success, error, seconds)`` of ``call(*task)`` for each task, in order, ``at_once`` children at a time.

    A call that takes more than ``seconds`` is ended and reported as timed out; so is a child that dies, with its exit
    code.  Other calls go on.  At most ``at_once`` children are alive, also if the caller stops reading.
    """
    context = multiprocessing.get_context("fork")
    todo, running, found = deque(enumerate(tasks)), {}, {}
    said = 0
    try:
        while todo or running:
            while todo and len(running) < at_once:
                no, args = todo.popleft()
                ours, theirs = context.Pipe(duplex=False)
                child = context.Process(target=_child, args=(call, args, theirs), daemon=True)
                child.start()
                theirs.close()  # the child has it; its end is the end of the pipe
                running[ours] = (no, child, time.monotonic())
            soonest = min(began for _, _, began in running.values()) + seconds
            ready = wait(list(running), max(0.0, soonest - time.monotonic()))
            late = [c for c, (_, _, began) in running.items() if c not in ready and time.monotonic() - began >= seconds]
            for c in [*ready, *late]:
                no, child, began = running[c]
                error = f"timed out after {seconds:g} seconds"
                if c in ready:
                    try:
                        error = c.recv()  # drained before the child is joined, as a full pipe would hold it
                    except EOFError:
                        child.join()
                        error = f"ended with exit code {child.exitcode}"
                _end(child)
                c.close()
                del running[c]
                found[no] = (error is None, error, time.monotonic() - began)
            while said in found:
                yield found.pop(said)
                said += 1
    finally:
        for c, (_, child, _) in running.items():
            _end(child)
            c.close()
