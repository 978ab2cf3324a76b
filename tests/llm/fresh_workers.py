"""Run by test_edges.py in a process of its own, from another folder: only the driver has the repository on its path.

The first texts that the workers see are null, so nothing that another text would have filled is there.

Argument: the repository.  Prints "operator table rows" for every operator and table, rows as JSON.
"""

import json
import sys

sys.path.insert(0, sys.argv[1])

import corpus_pipeline  # noqa: E402
from larkspur.llm import dac, debruijn, hmm, jaccard, licences, packing, pieces, quality, suffix  # noqa: E402
from larkspur.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, WORD_TOKENIZER, tokenizer_path  # noqa: E402
from larkspur.session import local_session  # noqa: E402

session = local_session("fresh", "8", 2)
session.sparkContext.setLogLevel("OFF")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TABLES = {
    "nulls": [(k, None) for k in range(1, 7)],
    "mixed": [(k, [" ".join(f"word{k}x{j}" for j in range(60)), None, ""][k % 3]) for k in range(1, 13)],
}
OPERATORS = {
    "op1": suffix.remove_strings,
    "op3": lambda d: pieces.round_trip(d, tokenizer_path(PIECE_MODEL)),
    "op4": licences.scan,
    "op5": debruijn.remove_passages,
    "op6": lambda d: quality.judge(d, None),
    "op7": lambda d: packing.pack_documents(d, tokenizer_path(WORD_TOKENIZER)),
    "op8": hmm.score_documents,
    "op9": jaccard.join_documents,
    "op10": lambda d: dac.token_files(d, tokenizer_path(BYTE_TOKENIZER)),
}
for name in TABLES:
    rows = [(k, t, "en", "s", len(t or "")) for k, t in TABLES[name]]
    docs = session.createDataFrame(rows, SCHEMA).coalesce(1)
    labels = session.createDataFrame([(k, k % 2, 0) for k, _ in TABLES[name]], "doc_id long, quality int, toxic int")
    for operator, run in OPERATORS.items():
        print(operator, name, json.dumps([r.asDict() for r in run(docs).collect()]))
    stages = {"quality": lambda d: quality.keep(d, quality.fit(d, labels))}
    stages |= {label: (lambda d, f=f: f(session, d, "")) for label, f in corpus_pipeline.STAGES[1:]}
    for stage, run in stages.items():
        print(stage.replace(" ", "_"), name, json.dumps([r.asDict() for r in run(docs).collect()]))
session.stop()
