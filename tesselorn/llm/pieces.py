"""SentencePiece models: reading the protobuf, and encoding and decoding with
the tokenizers library.

``parse`` reads the fields that matter straight from the wire format. ``backend``
rebuilds the model: normaliser (precompiled character map, white-space rules,
dummy prefix as the metaspace marker), the vocabulary with its scores, and byte
fallback. A unigram model becomes a Unigram model; a BPE model's scores rank its
merges. ``verify`` holds the result against the sentencepiece library itself.

The library's Unigram model would find control and byte pieces spelt out in a
text. So their names get a space, which no normalised text has, and unknown
pieces are turned to bytes here (``encoder``).
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselorn.llm.common import batch

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "\u2581"
#: What the sentencepiece library decodes unknown pieces to, and a space.
UNKNOWN_TEXT = " \u2047  "
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Characters that a call of the tokenizer gets at most, unless one text is longer.
CALL_CHARS = 400_000
PROBES = ["", " ", "a", "Hello  world", " x\ny\t", "\u00e9 \ufb01\u2460 \u65e5\u672c \U0001f600", "a" * 50, "<s> <0x41> <unk>", "The  quick   brown\u2581fox"]


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    extra_spaces: bool = True  # whether they are removed
    escape: bool = True

    @property
    def unk(self) -> int:
        return self.types.index(UNKNOWN)


def _fields(data: bytes):
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            n = varint()
            yield number, data[at : at + n]
            at += n
        elif wire in (1, 5):
            n = 8 if wire == 1 else 4
            yield number, data[at : at + n]
            at += n
        else:
            raise ValueError(f"wire type {wire}")


def parse(data: bytes) -> Model:
    m = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m.pieces.append(piece)
            m.scores.append(score)
            m.types.append(kind)
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    m.kind = v
                elif n == 35:
                    m.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    m.charsmap = v
                elif n == 3:
                    m.dummy_prefix = bool(v)
                elif n == 4:
                    m.extra_spaces = bool(v)
                elif n == 5:
                    m.escape = bool(v)
    if m.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are read")
    return m


def splits_at_spaces(m: Model) -> bool:
    """Whether no piece goes on over a space, so that words encode apart."""
    return not any(MARK in p.lstrip(MARK) for p, t in zip(m.pieces, m.types) if t in (NORMAL, USER_DEFINED))


def backend(m: Model):
    """The tokenizers-library form of the model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if m.kind == UNIGRAM:
        names = [p if t in (NORMAL, USER_DEFINED) else UNKNOWN_TEXT if t == UNKNOWN else p + " " for p, t in zip(m.pieces, m.types)]
        core = models.Unigram(list(zip(names, m.scores)), unk_id=m.unk, byte_fallback=False)
    else:
        ids = {p: i for i, p in enumerate(m.pieces)}
        usable = {p for p, t in zip(m.pieces, m.types) if t in (NORMAL, USER_DEFINED)}
        merges = []
        for piece in usable:
            for cut in range(1, len(piece)):
                a, b = piece[:cut], piece[cut:]
                if a in usable and b in usable:
                    merges.append((-m.scores[ids[piece]], ids[piece], ids[a], ids[b], a, b))
        core = models.BPE(ids, [x[4:] for x in sorted(merges)], unk_token=m.pieces[m.unk], fuse_unk=True, byte_fallback=m.byte_fallback)
    t = Tokenizer(core)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.extra_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if m.escape:
        steps.append(normalizers.Replace(" ", MARK))
    t.normalizer = normalizers.Sequence(steps)
    # BPE merges a whole text as fast as its words, and never over a space then
    if m.kind == UNIGRAM and splits_at_spaces(m):
        t.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    own = _unnamed(m) + [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    t.decoder = decoders.Sequence(own + ([decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []))
    if added := [AddedToken(p, normalized=False) for p, k in zip(m.pieces, m.types) if k == USER_DEFINED and MARK not in p]:
        t.add_tokens(added)
    return t


def _unnamed(m: Model) -> list:
    """Takes the space from the names that ``backend`` gives."""
    from tokenizers import decoders

    return [decoders.Strip(" ", 0, 1)] if m.kind == UNIGRAM else []


def encoder(t, m: Model):
    """A function from texts to the lists of their ids by ``t``."""
    byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(m.pieces, m.types)) if k == BYTE}

    def ids(texts: list[str]) -> list[list[int]]:
        found = [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
        if m.kind == UNIGRAM and m.byte_fallback:
            # only the slower call tells what an unknown piece is
            some = [n for n, own in enumerate(found) if m.unk in own]
            for n, e in zip(some, t.encode_batch([texts[n] for n in some], add_special_tokens=False)):
                found[n] = [x for i, text in zip(e.ids, e.tokens) for x in ([byte[b] for b in text.encode()] if i == m.unk else [i])]
        return found

    return ids


def restorer(t, m: Model):
    """A function from lists of ids that ``t`` encoded to their texts. What is
    encoded never spells a mark in bytes if the mark is a piece: then marks are
    replaced in the whole text, which is quicker than in each piece, with the
    same result. ``t`` must not decode other ids afterwards."""
    from tokenizers import decoders

    if (MARK, NORMAL) not in zip(m.pieces, m.types):
        return lambda ids: t.decode_batch(ids, skip_special_tokens=False)
    t.decoder = decoders.Sequence(_unnamed(m) + [decoders.ByteFallback(), decoders.Fuse()])

    def texts(ids: list[list[int]]) -> list[str]:
        back = (x.replace(MARK, " ") for x in t.decode_batch(ids, skip_special_tokens=False))
        return [x.removeprefix(" ") for x in back] if m.dummy_prefix else list(back)

    return texts


def verify(data: bytes, texts: list[str]) -> None:
    """Raises unless ids and decoded texts equal the sentencepiece library's."""
    import sentencepiece

    m = parse(data)
    theirs, ours = sentencepiece.SentencePieceProcessor(model_proto=data), backend(m)
    for text, ids in zip(texts, encoder(ours, m)(texts)):
        want = theirs.encode(text)
        if ids != want:
            raise ValueError(f"ids differ on {text[:80]!r}: {ids[:20]}, not {want[:20]}")
        if ours.decode(want) != theirs.decode(want):
            raise ValueError(f"decoded texts differ on {text[:80]!r}")


def read_model(path: str = MODEL) -> bytes:
    """The model file, read where the driver runs and sent to the executors."""
    with open(path, "rb") as f:
        return f.read()


def chunks(texts: list[str], most: int = CALL_CHARS):
    """Runs of texts of about ``most`` characters: a call's memory is bounded."""
    own, size = [], 0
    for text in texts:
        if own and size + len(text) > most:
            yield own
            own, size = [], 0
        own.append(text)
        size += len(text)
    if own:
        yield own


def encode(docs: DataFrame, model: bytes | None = None, id_col: str = "doc_id", text_col: str = "text", threads: int = 2) -> DataFrame:
    """(doc_id, n_tokens, ids, restored) for each row: piece ids of the whole
    text, and whether decoding gives the normalised text back. Null texts count
    as empty: no ids, restored. Batches are encoded by ``threads`` threads.
    Parity with the sentencepiece library is verified on fixed probes before the
    job and on the first texts of every task. Repeated rows give repeated rows.
    """
    data = model if model is not None else read_model()
    verify(data, PROBES)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("restored", pa.bool_())])

    def fold(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        parsed = parse(data)
        t, first = backend(parsed), True
        texts_of, ids_of = restorer(t, parsed), encoder(t, parsed)
        plain = not parsed.charsmap and not parsed.extra_spaces and parsed.escape
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [x or "" for x in part.column(1).to_pylist()]
                if first:
                    verify(data, [x[:2000] for x in texts[:8]])
                    first = False
                ids, same = [], []
                for some in chunks(texts):
                    found = ids_of(some)
                    back = texts_of(found)
                    ids += found
                    same += [x == (y if plain else t.normalizer.normalize_str(y).replace(MARK, " ")[int(parsed.dummy_prefix) :]) for x, y in zip(back, (s.replace(MARK, " ") for s in some))]
                yield batch(schema, doc_id=part.column(0), n_tokens=[len(x) for x in ids], ids=ids, restored=same)

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(fold, "doc_id long, n_tokens long, ids array<int>, restored boolean")


def decode(encoded: DataFrame, model: bytes | None = None) -> DataFrame:
    """(doc_id, text): the text of the ``ids`` of each row; null ids give empty."""
    data = model if model is not None else read_model()
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def fold(batches):
        t = backend(parse(data))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                yield batch(schema, doc_id=part.column(0), text=t.decode_batch([x or [] for x in part.column(1).to_pylist()], skip_special_tokens=False))

    return encoded.select("doc_id", "ids").mapInArrow(fold, "doc_id long, text string")
