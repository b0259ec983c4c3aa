"""Chat formatting: roles by a hidden Markov model, then canonical turns.

The rows of a conversation, in turn order, are read as a transcript.  A unit is the first
line of a row, or a later line that may be a speaker's marker, with the lines up to the
next such line.  Whether it is a marker the model decides.  Its states are a role and
how the unit stands to it: it opens a turn by its marker, opens a turn without one (only
the first unit of a row can), or continues the turn.  A unit shows the kind of its
marker, its length, lines and question mark.  Start, transition and emission
probabilities are counted over a bounded sample of units with known roles, on top of
fixed priors; the role column is read for that only.  Viterbi recovers the states of all
units.  A marker is stripped where a unit opens by it; every other word stays.

Units are range-partitioned on (conversation, turn), so a conversation may span
partitions: each partition's piece of it is a max-plus matrix, the chain of the
matrices (one or two per partition) fixes the states at the cuts, and every
partition then decodes its pieces alone.  The result is that of one Viterbi pass.

A turn is rendered as ``<|role|>``, its text without white space around it, and ``<|end|>``, on
lines of their own.  In the text every ``<|`` gets a backslash in between (and ``<\\|`` one
more), so no text can end or open a turn and the text can be had back.

Defined cases: a null text is an empty turn; null conversation ids form one
conversation; null turns come first, equal turns in table order; rows with unknown
or null roles are decoded like any other; without training rows transitions
alternate between user and assistant; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweave.llm.common import hash_sample, numbered, small_batches, staged
from logweave.operators.scan import pinned

ROLES = ("assistant", "system", "tool", "user")
#: Bound on the units that training reads.
SAMPLE = 20_000
#: Units in a range partition, which a task holds.
UNITS_PER_PARTITION = 500_000
#: Turns in a block, which the sample takes or leaves as a whole.
BLOCK = 100
#: Usual speaker names by role, and of them those that often stand for
#: something else at the start of a line.
SPEAKERS = {"assistant": "assistant ai bot chatbot model answer agent gpt response",
            "system": "system instruction instructions",
            "tool": "tool function observation",
            "user": "user human question customer prompt visitor me"}
WEAK = frozenset("model answer agent response instruction instructions tool function observation question "
                 "customer prompt visitor me".split())
_ROLE_OF = {n: r for r, ns in SPEAKERS.items() for n in ns.split()}
_MARK = re.compile(r"^[ \t]*(?:#{1,4}[ \t]*|<\|?|\[|\*{1,2})?(%s)(?:\|?>|\]|\*{1,2})?[ \t]*(?::\*{0,2}|>|(?<=[>\]])|\n)[ \t]*"
                   % "|".join(sorted(_ROLE_OF, key=len, reverse=True)), re.I)
#: How a unit stands to its turn; a state is ``kind * len(ROLES) + role``.
MARKED, PLAIN, GOES_ON = 0, 1, 2
#: Kinds of markers: none; a name with a colon or brackets, usual or weak, each with and without
#: markers of other roles in this form in the row; a bare name on a line, likewise (weak names
#: and those with nothing to say never count as a style).
NO_MARK, USUAL_STYLED, USUAL, WEAK_STYLED, WEAK_ALONE, BARE_STYLED, BARE = range(7)
#: Prior shares of the kinds for each way to stand, and how often a later line opens a turn.
PRIOR = ((0, .50, .30, .13, .01, .05, .01), (.93, .005, .01, .01, .02, .005, .02),
         (.96, .002, .004, .01, .015, .001, .008))
OPENS = .2
_NEVER = -1e9
_UNIT = ("conv_id {c}, turn {t}, rid bigint, sub int, role string, mark int, kind int, size int, lines int, "
         "ask int, cut int, text string")


def units_of(text: str | None) -> list[tuple[int, int, int, str]]:
    """(marked role or -1, kind of marker, characters of the marker, text) of each unit."""
    lines = (text or "").split("\n")
    marks = [_MARK.match(x + "\n") for x in lines]
    roles: dict[str, set] = {}
    for m in filter(None, marks):
        if _form(m) or m[1].lower() not in WEAK:
            roles.setdefault(_form(m), set()).add(_ROLE_OF[m[1].lower()])
    out: list[list] = []
    for line, m in zip(lines, marks):
        if m:
            form = _form(m)
            styled = len(roles.get(form, ())) > 1
            if not form:
                kind = BARE_STYLED if styled and m[1].lower() not in WEAK else BARE
            elif m[1].lower() in WEAK and form in (":", ">"):
                kind = WEAK_STYLED if styled else WEAK_ALONE
            else:
                kind = USUAL_STYLED if styled else USUAL
            out.append([ROLES.index(_ROLE_OF[m[1].lower()]), kind, min(m.end(), len(line)), [line]])
        elif not out:
            out.append([-1, NO_MARK, 0, [line]])
        else:
            out[-1][3].append(line)
    texts = ["\n".join(x[3]) for x in out]
    return [(r, BARE if k == BARE_STYLED and not t[c:].strip() else k, c, t)
            for (r, k, c, _), t in zip(out, texts)]


def _form(m: re.Match) -> str:
    """What a marker has besides its name; empty for a bare name."""
    return "".join((m[0][:m.start(1)] + m[0][m.end(1):]).split())


def split_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per unit with its features (staged)."""
    small_batches(conversations.sparkSession)
    t = numbered(conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).alias("text")), "chat-rows")
    kind = {f.name: f.dataType.simpleString() for f in t.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            src, rows = [], []
            for i, text in enumerate(pdf["text"]):
                for sub, (mark, kind, cut, body) in enumerate(units_of(text)):
                    src.append(i)
                    rows.append((sub, mark + 1, kind, (len(body) - cut).bit_length(),
                                 min(body.count("\n"), 7), int(body.rstrip().endswith(("?", "？"))), cut, body))
            out = pdf.iloc[src][["conv_id", "turn", "rid", "role"]].reset_index(drop=True)
            new = pd.DataFrame(rows, columns=["sub", "mark", "kind", "size", "lines", "ask", "cut", "text"])
            out.loc[new["sub"] > 0, "role"] = None
            yield pd.concat([out, new], axis=1)

    return staged(t.mapInPandas(run, _UNIT.format(c=kind["conv_id"], t=kind["turn"])), "chat-units")


def train(units: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Log probabilities: start (of a state), step (from state to state), one table per
    feature by role, and the kinds of markers by how a unit stands."""
    block = F.floor(F.coalesce(F.col("turn").cast("double"), F.col("rid").cast("double")) / BLOCK)
    units = units.select("conv_id", "turn", "rid", "sub", "role", "mark", "kind", "size", "lines", "ask",
                         block.alias("block"))
    rows = hash_sample(units, ["conv_id", "block"], sample,
                       order=["conv_id", "block", "turn", "rid", "sub"]).collect()      # <= sample
    S = len(ROLES)
    start, step = np.full(S, .1), np.full((S, S), .1)
    step[0, 3] += 1
    step[3, 0] += 1
    step[1, [0, 3]] += 1
    start[[1, 3]] += 1
    emit = {"size": np.full((S, 33), .5), "lines": np.full((S, 8), .5), "ask": np.full((S, 2), .5)}
    kinds = 40 * np.array(PRIOR) + 1e-9
    before, piece = -1, object()
    for r in rows:
        if r.sub:                       # whose turn it is, the role column does not say
            continue
        name = (r.role or "").strip().lower()
        now = ROLES.index(name) if name in ROLES else -1
        if now >= 0:
            for k, tab in emit.items():
                tab[now, min(r[k], tab.shape[1] - 1)] += 1
            kinds[MARKED if r.mark == now + 1 else PLAIN, r.kind] += 1
            if (r.conv_id, r.block) != piece:
                start[now] += r.block == 0
            elif before >= 0:
                step[before, now] += 1
        before, piece = now, (r.conv_id, r.block)
    norm = lambda a: np.log(a / a.sum(axis=-1, keepdims=True))
    whole = np.full((3 * S, 3 * S), _NEVER)
    whole[:, :2 * S] = np.tile(norm(step), (3, 2))
    whole[np.arange(3 * S), 2 * S + np.arange(3 * S) % S] = 0
    return {"start": np.r_[np.tile(norm(start), 2), np.full(S, _NEVER)], "step": whole,
            "kinds": norm(kinds), **{k: norm(v) for k, v in emit.items()}}


def _scores(pdf: pd.DataFrame, m: dict[str, np.ndarray]) -> np.ndarray:
    """Log probability of each unit's features in each state."""
    S = len(ROLES)
    of_role = sum(m[k][:, np.minimum(pdf[k].to_numpy(), m[k].shape[1] - 1)].T
                  for k in ("size", "lines", "ask"))
    kinds = m["kinds"][:, pdf["kind"].to_numpy()].T
    first = (pdf["sub"].to_numpy() == 0)[:, None]
    out = np.full((len(pdf), 3 * S), _NEVER)
    named = pdf["mark"].to_numpy()[:, None] == np.arange(1, S + 1)
    opens = np.where(first, np.log(.5), np.log(OPENS))
    out[:, :S] = np.where(named, of_role + kinds[:, MARKED, None] + opens, _NEVER)
    out[:, S:2 * S] = np.where(first, of_role + kinds[:, PLAIN, None] + np.log(.5), _NEVER)
    any_role = np.log(np.exp(of_role - of_role.max(axis=1, keepdims=True)).mean(axis=1, keepdims=True)) \
        + of_role.max(axis=1, keepdims=True)
    out[:, 2 * S:] = np.where(first, _NEVER, any_role + kinds[:, GOES_ON, None] + np.log(1 - OPENS))
    return out


def _decode(e: np.ndarray, cut: np.ndarray, m: dict, entry: int | None, leave: int | None) -> np.ndarray:
    """Best states of the pieces that start at ``cut`` for scores ``e``, all pieces at
    once, given the state before the first piece and the last state of the last one."""
    length = np.diff(np.r_[cut, len(e)])
    order = np.argsort(-length, kind="stable")
    at, length = cut[order], length[order]
    v = m["start"] + e[at]
    if entry is not None:
        first = int(np.flatnonzero(at == 0)[0])
        v[first] = m["step"][entry] + e[0]
    back = np.zeros(e.shape, np.int8)
    for i in range(1, int(length[0])):
        n = int(np.searchsorted(-length, -i))           # pieces longer than i
        w = v[:n, :, None] + m["step"]
        back[at[:n] + i] = w.argmax(axis=1)
        v[:n] = w.max(axis=1) + e[at[:n] + i]
    state = v.argmax(axis=1)
    if leave is not None:
        state[int(np.flatnonzero(at + length == len(e))[0])] = leave
    out = np.empty(len(e), np.int64)
    out[at + length - 1] = state
    for i in range(int(length[0]) - 1, 0, -1):
        n = int(np.searchsorted(-length, -i))
        out[at[:n] + i - 1] = back[at[:n] + i, out[at[:n] + i]]
    return out


def _matrix(e: np.ndarray, m: dict, opens: bool) -> np.ndarray:
    """Best score from each state before the piece (or from the start) to each
    state of its last unit."""
    a = np.tile(m["start"] + e[0], (len(m["start"]), 1)) if opens else m["step"] + e[0]
    for i in range(1, len(e)):
        a = (a[:, :, None] + m["step"][None]).max(axis=1) + e[i]
    return a


def _pieces(batches: Iterator[pd.DataFrame]) -> tuple[pd.DataFrame, np.ndarray]:
    got = [p for p in batches if len(p)]
    if not got:
        return pd.DataFrame(), np.zeros(0, np.int64)
    pdf = pd.concat(got, ignore_index=True)
    c = pdf["ckey"].to_numpy(object)
    return pdf, np.flatnonzero(np.r_[True, c[1:] != c[:-1]])


def viterbi(units: DataFrame, model: dict[str, np.ndarray], partitions: int | None = None) -> DataFrame:
    """rid, sub, role and stands (MARKED, PLAIN or GOES_ON) for every unit."""
    n = partitions or max(int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                          units.count() // UNITS_PER_PARTITION + 1)
    order = ["ckey", "turn", "rid", "sub"]
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = pinned(units.select(key.alias("ckey"), "turn", "rid", "sub", "mark", "kind", "size", "lines", "ask")
                  .repartitionByRange(n, *order).sortWithinPartitions(*order))

    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf, cut = _pieces(batches)
        if not len(pdf):
            return
        e, stop = _scores(pdf, model), np.r_[cut[1:], len(pdf)]
        c = pdf["ckey"]
        yield pd.DataFrame([{
            "pid": TaskContext.get().partitionId(), "first": c.iloc[0], "last": c.iloc[-1],
            "lead": _matrix(e[:stop[0]], model, False).ravel().tolist(),
            "tail0": _matrix(e[cut[-1]:], model, True).ravel().tolist(), "one": len(cut) == 1}])

    S = 3 * len(ROLES)
    got = sorted(rows.mapInPandas(
        summary, "pid int, first string, last string, lead array<double>, "
                 "tail0 array<double>, one boolean").collect(), key=lambda r: r.pid)
    entry, leave = _cut_states(got, S)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf, cut = _pieces(batches)
        if not len(pdf):
            return
        pid = TaskContext.get().partitionId()
        states = _decode(_scores(pdf, model), cut, model, entry.get(pid), leave.get(pid))
        out = pdf[["rid", "sub"]].copy()
        out["role"] = np.array(ROLES, object)[states % len(ROLES)]
        out["stands"] = (states // len(ROLES)).astype(np.int32)
        yield out

    return rows.mapInPandas(decode, "rid bigint, sub int, role string, stands int")


def _cut_states(got: list, S: int) -> tuple[dict[int, int], dict[int, int]]:
    """States before and at the end of the partitions where a conversation goes on;
    ``got`` has one record per partition."""
    entry, leave = {}, {}
    i = 0
    while i < len(got):
        j = i
        while j + 1 < len(got) and got[j + 1].first == got[j].last and (j == i or got[j].one):
            j += 1
        if j > i:
            chain = [np.array(got[i].tail0).reshape(S, S)[0]]
            for k in range(i + 1, j + 1):
                chain.append((chain[-1][:, None] + np.array(got[k].lead).reshape(S, S)).max(axis=0))
            state = int(chain[-1].argmax())
            for k in range(j, i, -1):
                leave_k = state
                state = int((chain[k - i - 1] + np.array(got[k].lead).reshape(S, S)[:, state]).argmax())
                if got[k].one:
                    leave[got[k].pid] = leave_k
                entry[got[k].pid] = state
            leave[got[i].pid] = state
        i = max(j, i + 1)
    return entry, leave


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """conv_id, turn, part (number of the turn in the row's text), role, rendered."""
    units = split_turns(conversations, conv_col, turn_col, role_col, text_col)
    states = viterbi(units, train(units, sample))
    body = F.when(F.col("stands") == MARKED, F.expr("substring(text, cut + 1)")).otherwise(F.col("text"))
    row = Window.partitionBy("rid").orderBy("sub")
    said = units.drop("role").join(states, ["rid", "sub"]).withColumns({
        "part": F.count_if(F.col("stands") != GOES_ON).over(row) - 1, "body": body})
    turns = said.groupBy("rid", "part").agg(
        F.first("conv_id").alias("conv_id"), F.first("turn").alias("turn"), F.first("role").alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sub", "body"))),
                                 lambda x: x["body"]), "\n").alias("text"))
    return turns.select("conv_id", "turn", F.col("part").cast("int").alias("part"), "role", F.concat(
        F.lit("<|"), "role", F.lit("|>\n"), escaped(F.col("text")), F.lit("\n<|end|>")).alias("rendered"))


def escaped(text: Column) -> Column:
    """The text of a turn without white space around it, no marker in it."""
    bare = F.regexp_replace(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+\z", "")
    return F.regexp_replace(bare, r"<(\\*)\|", r"<\\$1|")
