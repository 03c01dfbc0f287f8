"""The same results as the catalog's queries, as plain SQL for another engine."""

from __future__ import annotations

from loomfeed.operators.augment import COLUMN_WORDS, SLOT_WORDS
from loomfeed.operators.checks import REQUIRED
from loomfeed.operators.vocab import BOS_ID, EOS_ID, PAD_ID, SPECIALS, UNK_ID
from loomfeed.plans import catalog as q
from loomfeed.sources import NA_WORDS

Ctes = dict[str, str]


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def query(ctes: Ctes, body: str) -> str:
    return "with recursive " + ",\n".join(f"{name} as ({sql})" for name, sql in ctes.items()) + "\n" + body


EXAMPLES: Ctes = {
    "turns": """
        select conv_id, turn, role, text,
               lead(text) over (partition by conv_id order by turn) as next_text,
               lead(role) over (partition by conv_id order by turn) as next_role
        from conversations""",
    "systems": """
        select conv_id, min(text) as system_text from conversations
        where role = 'system' group by conv_id""",
    "examples": """
        select concat_ws('-', t.conv_id, t.turn) as ex_id,
               case when t.conv_id % 5 = 0 then t.text
                    else concat('Instruction: ', t.text) end as instruction,
               case when s.system_text is not null
                      then concat('Input: ', s.system_text, ' Input: ', s.system_text)
                    when t.conv_id % 7 = 0 then '' end as input,
               concat('Output: ', t.next_text) as output
        from turns t left join systems s on t.conv_id = s.conv_id
        where t.role = 'user' and t.next_role = 'assistant'""",
}


def copies_of(source: str, n: int = q.COPIES) -> str:
    return f"""
        select e.*, c.copy_id from {source} e
        cross join (select cast(range as int) as copy_id from range({n})) c"""


COPIES: Ctes = {**EXAMPLES, "copies": copies_of("examples")}


def drawn(n: int, *keys: str) -> str:
    return f"cast('0x' || substr(md5(concat_ws('|', {', '.join(keys)})), 1, 8) as bigint) % {n}"


def chosen(words, column: str) -> str:
    words = list(words)
    if len(words) == 1:
        return lit(words[0])
    key = ["'42'", "ex_id", "copy_id", lit(column)]
    return f"{lits(words)}[{drawn(len(words), *key)} + 1]"


def first_replaced(text: str, keyword: str, word: str) -> str:
    at = f"instr({text}, {lit(keyword)})"
    return (
        f"case when {at} > 0 then concat(substr({text}, 1, {at} - 1), {word}, "
        f"substr({text}, {at} + {len(keyword)})) else {text} end"
    )


def varied_slots(source: str) -> str:
    cols = [
        f"replace({c}, {lit(SLOT_WORDS[2 * i])}, {chosen(SLOT_WORDS[2 * i + 1:], c)}) as {c}"
        for i, c in enumerate(REQUIRED)
    ]
    return f"select ex_id, copy_id, {', '.join(cols)} from {source}"


def varied_columns(source: str, variations=COLUMN_WORDS, null_literal: str | None = None) -> str:
    cols = []
    for c in REQUIRED:
        text = c
        if c in variations:
            if null_literal is not None:
                text = f"coalesce({c}, {lit(null_literal)})"
            text = first_replaced(text, variations[c][0], chosen(variations[c][1:], c))
        cols.append(f"{text} as {c}")
    return f"select ex_id, copy_id, {', '.join(cols)} from {source}"


def full_prompt() -> str:
    return (
        "concat('Instruction: ', coalesce(instruction, 'None'), chr(10), 'Input: ', "
        "coalesce(input, 'None'), chr(10), 'Output: ', coalesce(output, 'None'))"
    )


def optional_prompt() -> str:
    return (
        f"case when input is not null and input <> '' then {full_prompt()} else "
        "concat('Instruction: ', coalesce(instruction, 'None'), chr(10), "
        "'Output: ', coalesce(output, 'None')) end"
    )


def prompts(varied: str, prompt: str) -> Ctes:
    return {"varied": varied, "prompts": f"select ex_id, copy_id, {prompt} as prompt from varied"}


PROMPTS_V1: Ctes = {**COPIES, **prompts(varied_slots("copies"), full_prompt())}
PROMPTS_V2: Ctes = {**COPIES, **prompts(varied_columns("copies"), optional_prompt())}


def encoded(source: str, text: str, key: str, size: int, length: int | str) -> Ctes:
    """Vocabulary of ``source`` and its ids, cut to ``length``."""
    specials = ", ".join(f"({lit(t)}, {i})" for i, t in enumerate(SPECIALS))
    keys = ", ".join(f"s.{k.strip()}" for k in key.split(","))
    same = " and ".join(f"s.{k.strip()} = i.{k.strip()}" for k in key.split(","))
    return {
        "lists": f"""
            select {key}, list_filter(regexp_split_to_array({text}, '[ \\n\\t\\r]+'), lambda w: w <> '') as words
            from {source}""",
        "tokens": f"select {key}, unnest(range(len(words))) as pos, unnest(words) as tok from lists",
        "counted": f"""
            select tok, count(*) as n from tokens
            where tok not in ({', '.join(lit(s) for s in SPECIALS)}) group by tok""",
        "ranked": "select tok, row_number() over (order by n desc, tok) as r from counted",
        "vocab": f"""
            select tok, cast(id as int) as id from (values {specials}) t(tok, id)
            union all
            select tok, cast(r + {len(SPECIALS) - 1} as int) as id from ranked where r <= {size}""",
        "id_lists": f"""
            select {key}, list(coalesce(id, {UNK_ID}) order by pos) as ids
            from tokens left join vocab using (tok) where pos < {length} group by {key}""",
        "encoded": f"""
            select {keys}, coalesce(i.ids, []) as ids
            from {source} s left join id_lists i on {same}""",
    }


def filled(value: int, times: str) -> str:
    return f"list_transform(range({times}), lambda x: {value})"


def padded(length: str | int, pad_id: int = PAD_ID) -> str:
    return f"list_concat(ids, {filled(pad_id, f'{length} - len(ids)')})"


def masked(length: str | int) -> str:
    return f"list_concat({filled(1, 'len(ids)')}, {filled(0, f'{length} - len(ids)')})"


def labelled(ids: str, pad_id: int = PAD_ID) -> str:
    return f"list_transform({ids}, lambda x: case when x = {pad_id} then -100 else x end)"


def text_of(value: str) -> str:
    return f"array_to_string({value}, ' ')"


def finished(length: int | str, pad_id: int = PAD_ID, labels: bool = True) -> str:
    cols = [
        f"{text_of(padded(length, pad_id))} as input_ids",
        f"{text_of(masked(length))} as attention_mask",
    ]
    if labels:
        cols.append(f"{text_of(labelled(padded(length, pad_id), pad_id))} as labels")
    return ", ".join(cols)


IDS: Ctes = {**PROMPTS_V2, **encoded("prompts", "prompt", "ex_id, copy_id", q.VOCAB, q.LENGTH)}
IDS_V1: Ctes = {**PROMPTS_V1, **encoded("prompts", "prompt", "ex_id, copy_id", q.VOCAB, q.LENGTH)}


#: words of the longest text
LONGEST = "(select max(len(words)) from lists)"


def document_ids(length: int | str = q.LENGTH) -> Ctes:
    return encoded("documents", "text", "doc_id", q.DOCUMENT_VOCAB, length)


def content_hash(columns) -> str:
    parts = [f"coalesce(cast(length({c}) as varchar) || ':' || {c}, '-')" for c in columns]
    return f"md5({' || '.join(parts)})"


# what the CSV holds: an empty cell is a missing one
CSV_ROWS: Ctes = {
    **EXAMPLES,
    "cells": "select instruction, nullif(input, '') as input, output from examples",
}
STREAMED: Ctes = {
    **CSV_ROWS,
    "keyed": f"select {content_hash(REQUIRED)} as ex_id, * from cells",
    "copies": copies_of("keyed"),
    **prompts(varied_columns("copies"), optional_prompt()),
}
FROM_CSV: Ctes = {
    **CSV_ROWS,
    "keyed": f"""
        select concat_ws('-', {content_hash(REQUIRED)},
                         row_number() over (partition by instruction, input, output) - 1) as ex_id, *
        from cells""",
    "copies": copies_of("keyed"),
    **prompts(varied_columns("copies"), optional_prompt()),
    **encoded("prompts", "prompt", "ex_id, copy_id", q.VOCAB, q.LENGTH),
}
LITERAL_NAN: Ctes = {
    **COPIES,
    **prompts(varied_columns("copies", null_literal="nan"), optional_prompt()),
    **encoded("prompts", "prompt", "ex_id, copy_id", q.VOCAB, q.LENGTH),
}
SWITCHED_OFF: Ctes = {
    **EXAMPLES,
    "prompts": f"select ex_id, cast(0 as int) as copy_id, {optional_prompt()} as prompt from examples",
    **encoded("prompts", "prompt", "ex_id, copy_id", q.VOCAB, q.LENGTH),
}


def split_cte(source: str = "examples", key: str = "ex_id") -> str:
    return f"""
        select {key}, case when row_number() over (order by md5(concat_ws('|', '{q.SEED}', {key})), {key})
                 <= ceil(cast(count(*) over () as double) * cast({q.TEST_SIZE} as double))
               then 'test' else 'train' end as split
        from (select distinct {key} from {source})"""


def places(source: str, epochs: int = q.EPOCHS) -> str:
    return f"""
        select ex_id, copy_id, epoch,
               row_number() over (partition by epoch
                 order by md5(concat_ws('|', '{q.SEED}', epoch, ex_id, copy_id)), ex_id, copy_id) - 1 as position
        from {source} cross join (select cast(range as int) as epoch from range({epochs})) e"""


def batch_places(source: str, batch: int = q.BATCH, world: int = q.WORLD, accum: int = q.ACCUM) -> str:
    return f"""
        select *, cast(position % {batch} as int) as slot,
               cast((position // {batch}) % {world} as int) as rank,
               position // {batch * world} as micro,
               position // {batch * world * accum} as step
        from {source}"""


PLACES: Ctes = {**COPIES, "places": places("copies"), "batches": batch_places("places")}

# documents keyed by their text: many equal keys, and every tenth one null
EQUAL_ROWS: Ctes = {
    "keyed": f"select case when doc_id % 10 <> 0 then {content_hash(['text'])} end as ex_id from documents",
    "copies": copies_of("keyed"),
    "places": places("copies"),
}

SPECIAL_IDS = f"""
    select case when d.doc_id % 10 <> 0 then source end as source,
           {text_of(f'list_concat([{BOS_ID}], list_concat(ids, [{EOS_ID}]))')} as ids
    from encoded e join documents d on e.doc_id = d.doc_id"""

def cell(value: str) -> str:
    """What a CSV cell is read as: words for missing values are null."""
    return f"case when {value} is null or list_contains({lits(NA_WORDS)}, {value}) then null else {value} end"


# documents as examples, written to CSV
DOCUMENT_CELLS: Ctes = {
    "cells": f"""
        select doc_id, {cell('text')} as instruction, {cell('source')} as input, {cell('lang')} as output
        from documents"""
}
# line breaks in the values of a file with CRLF are written as CRLF
MIXED_CELLS: Ctes = {
    "written": f"""
        select {cell('text')} as text, {cell('source')} as input, {cell('lang')} as output from documents""",
    "cells": """
        select case when output = 'en' then text else replace(text, chr(10), chr(13) || chr(10)) end as instruction,
               input, output
        from written""",
}
STREAMED_FILES: Ctes = {
    **MIXED_CELLS,
    "keyed": f"select {content_hash(REQUIRED)} as ex_id, instruction, input, output from cells",
    "copies": copies_of("keyed"),
    **prompts(varied_columns("copies"), optional_prompt()),
}


def row_index_prompts(varied: str, prompt: str) -> Ctes:
    """Prompts of the examples keyed by their place in the order of their ids."""
    return {
        **EXAMPLES,
        "keyed": """
            select row_number() over (order by ex_id) - 1 as ex_id, instruction, nullif(input, '') as input, output
            from examples""",
        "copies": copies_of("keyed"),
        **prompts(varied, prompt),
        **encoded("prompts", "prompt", "ex_id, copy_id", q.VOCAB, q.LENGTH),
    }


GROWN: Ctes = {
    "words": """
        select coalesce(lang = 'en', false) as english,
               unnest(list_filter(regexp_split_to_array(text, '[ \\n\\t\\r]+'), lambda w: w <> '')) as tok
        from documents""",
    "counted": f"""
        select tok, count(*) as n, count(*) filter (english) as n_english from words
        where tok not in ({', '.join(lit(s) for s in SPECIALS)}) group by tok""",
    "old": f"""
        select tok, row_number() over (order by n_english desc, tok) as r from counted
        where n_english > 0 qualify r <= {q.VOCAB}""",
    "new": f"""
        select tok, row_number() over (order by n desc, tok) as r, (select count(*) from old) as held
        from counted where tok not in (select tok from old)
        qualify r + held + {len(SPECIALS)} <= {q.DOCUMENT_VOCAB}""",
}

LONGEST_PIECE = 16
PIECES: Ctes = {
    **encoded("documents", "text", "doc_id", q.PIECES, q.LENGTH),
    "letters": """
        select distinct unnest(regexp_extract_all(text, '[^ \\n\\t\\r]')) as tok from documents""",
    "pieces": """
        select tok, id from vocab
        union all
        select tok, cast(row_number() over (order by tok) + (select max(id) from vocab) as int)
        from letters where tok not in (select tok from vocab)""",
    "starts": f"""
        select tok as word, unnest(range(1, length(tok) + 1)) as place
        from (select distinct tok from tokens where pos < {q.LENGTH})""",
    "best": f"""
        select word, place, max(n) as n, arg_max(id, n) as id
        from (select *, unnest(range(1, {LONGEST_PIECE + 1})) as n from starts) c
        join pieces p on substr(word, place, n) = p.tok and length(p.tok) = n
        group by word, place""",
    "walk": f"""
        select word, cast(1 as bigint) as place, cast(0 as bigint) as k from (select distinct word from starts)
        union all
        select w.word, w.place + b.n, k + 1 from walk w join best b using (word, place)""",
    "cut": "select word, list(id order by place) as ids from walk join best using (word, place) group by word",
    "listed": f"""
        select doc_id, flatten(list(c.ids order by pos))[:{q.LENGTH}] as ids
        from tokens t join cut c on t.tok = c.word where pos < {q.LENGTH} group by doc_id""",
}


def hashed(turn: int, digit: str) -> str:
    return f"cast('0x' || substr(md5(concat_ws('|', '{q.SEED}', epoch, {turn}, {digit})), 1, 12) as bigint)"


def keyed_walk() -> str:
    turns = "select row_index, epoch, k, n, a, b, x // b as l, x % b as r from walk cross join shape where k = 0 or x >= n"
    for turn, (digit, other, base) in enumerate([("l", "r", "a"), ("r", "l", "b")] * 2):
        turns = f"select * replace (({digit} + {hashed(turn, other)}) % {base} as {digit}) from ({turns})"
    return f"""
        select row_index, epoch, row_index as x, 0 as k
        from numbered cross join (select cast(range as int) as epoch from range({q.EPOCHS})) e
        union all
        select row_index, epoch, l * b + r, k + 1 from ({turns})"""


KEYED: Ctes = {
    **COPIES,
    "numbered": "select ex_id, copy_id, row_number() over (order by copy_id, ex_id) - 1 as row_index from copies",
    "shape": """
        select n, a, (n + a - 1) // a as b
        from (select count(*) as n, cast(ceil(sqrt(count(*))) as bigint) as a from numbered)""",
    "walk": keyed_walk(),
    "places": """
        select ex_id, copy_id, epoch, x as position, row_index
        from walk join numbered using (row_index) cross join shape where k > 0 and x < n""",
}

_SWITCH_ROWS = "instruction, input, output from examples"

ORACLE: dict[str, str] = {
    "scan_instruction_csv": query(CSV_ROWS, "select instruction, input, output from cells"),
    "scan_row_index": query(
        DOCUMENT_CELLS,
        "select row_number() over (order by doc_id) - 1 as row_index, instruction, input, output from cells",
    ),
    "scan_mixed_headers": query(MIXED_CELLS, "select instruction, input, output from cells"),
    "stream_csv_files": query(STREAMED_FILES, "select ex_id, copy_id, prompt from prompts"),
    "grow_vocab": query(
        GROWN,
        f"""select tok, cast(id as int) as id from (values {', '.join(f"({lit(t)}, {i})" for i, t in enumerate(SPECIALS))}) t(tok, id)
            union all select tok, cast(r + {len(SPECIALS) - 1} as int) from old
            union all select tok, cast(r + held + {len(SPECIALS) - 1} as int) from new""",
    ),
    "encode_pieces": query(
        PIECES,
        f"select d.doc_id, coalesce({text_of('ids')}, '') as ids"
        " from documents d left join listed using (doc_id)",
    ),
    "augment_report_stream": query(
        COPIES,
        "select count(*) filter (copy_id = 0) as rows_before, count(*) as rows_after from copies",
    ),
    "epoch_keyed": query(KEYED, "select ex_id, copy_id, epoch, position, row_index from places"),
    "epoch_resumed": query(
        {**KEYED, "batches": batch_places("places")},
        f"select ex_id, copy_id, epoch, rank, micro, step, slot from batches"
        f" where position >= {q.RESUMED * q.BATCH * q.WORLD * q.ACCUM}",
    ),
    "prepare_dataset_v1_row_index": query(
        row_index_prompts(varied_slots("copies"), full_prompt()),
        f"select ex_id, copy_id, {finished(q.LENGTH, labels=False)} from encoded",
    ),
    "prepare_dataset_v2_row_index": query(
        row_index_prompts(varied_columns("copies"), optional_prompt()),
        f"select ex_id, copy_id, {finished(q.LENGTH)} from encoded",
    ),
    "normalize_missing": f"""
        with cells as (
          select doc_id, case when doc_id % 2 = 0 then {lits(NA_WORDS)}[doc_id % {len(NA_WORDS)} + 1]
                              else source end as cell
          from documents)
        select doc_id, case when list_contains({lits(NA_WORDS)}, cell) then null else cell end as cell
        from cells""",
    "stream_instruction_csv": query(STREAMED, "select ex_id, copy_id, prompt from prompts"),
    **dict.fromkeys(
        ["write_examples", "write_planned"],
        query(
            {**COPIES, "marked": split_cte()},
            "select c.ex_id, c.copy_id, instruction, input, output, split"
            " from copies c join marked m on c.ex_id = m.ex_id",
        ),
    ),
    "row_keys": f"""
        select concat_ws('-', {content_hash(['text'])},
                         row_number() over (partition by text) - 1) as ex_id, text
        from documents""",
    "skip_absent_column": query(
        COPIES, varied_columns("copies", {"instruction": ["Instruction:", "Task:"]})
    ),
    "cast_text": query(
        EXAMPLES,
        "select cast(ex_id as varchar) as ex_id, input as kept, coalesce(input, 'nan') as filled from examples",
    ),
    "contains_keyword": query(
        EXAMPLES,
        "select ex_id, cast(contains(instruction, 'Instruction:') as int) as in_instruction,"
        " cast(coalesce(contains(input, 'Input:'), false) as int) as in_input from examples",
    ),
    "has_input": query(
        EXAMPLES,
        "select ex_id, cast(input is not null and input <> '' as int) as present from examples",
    ),
    "drop_source_columns": query(
        SWITCHED_OFF, f"select ex_id, copy_id, {finished(q.LENGTH)} from encoded"
    ),
    "augment_switches": query(
        {**EXAMPLES, "twice": copies_of("examples", 2)},
        f"""select 'off' as mode, ex_id, cast(0 as int) as copy_id, {_SWITCH_ROWS}
            union all select 'nothing_to_do', ex_id, cast(0 as int), {_SWITCH_ROWS}
            union all select 'one_word', ex_id, cast(0 as int), {_SWITCH_ROWS}
            union all select 'copies_only', ex_id, copy_id, instruction, input, output from twice""",
    ),
    "replicate": query(COPIES, "select ex_id, copy_id, instruction from copies"),
    "renumber": query(
        COPIES,
        "select row_number() over (order by copy_id, ex_id) - 1 as row_index, ex_id, copy_id from copies",
    ),
    "replace_all": query(
        EXAMPLES, "select ex_id, replace(input, 'Input:', 'Context:') as input from examples"
    ),
    "replace_first": query(
        EXAMPLES,
        f"select ex_id, {first_replaced('input', 'Input:', lit('Context:'))} as input from examples",
    ),
    "variant_candidates": query(
        EXAMPLES,
        "select ex_id, cast(v.place as int) as place, replace(input, 'Input:', v.word) as candidate"
        " from examples cross join (values (0, 'Context:'), (1, 'Output:'), (2, 'Response:')) v(place, word)",
    ),
    "uniform_choice": query(
        COPIES,
        f"select ex_id, copy_id, {chosen(['Task:', 'Objective:', 'Goal:'], 'instruction')} as chosen from copies",
    ),
    "vary_slots": query(COPIES, varied_slots("copies")),
    "vary_columns": query(COPIES, varied_columns("copies")),
    "vary_columns_literal_nan": query(COPIES, varied_columns("copies", null_literal="nan")),
    "prompt_full": query(EXAMPLES, f"select ex_id, {full_prompt()} as prompt from examples"),
    "prompt_optional_input": query(EXAMPLES, f"select ex_id, {optional_prompt()} as prompt from examples"),
    "tokenize_batches": query(IDS, f"select ex_id, copy_id, {text_of('ids')} as ids from encoded"),
    "build_vocab": query(IDS, "select tok, id from vocab"),
    "build_vocab_documents": query(document_ids(), "select tok, id from vocab"),
    "encode_words": query(IDS, f"select ex_id, copy_id, {text_of('ids')} as ids from encoded"),
    "encode_words_shuffled": query(IDS, f"select ex_id, copy_id, {text_of('ids')} as ids from encoded"),
    "encode_words_special_ids": query(document_ids(q.LENGTH - 2), SPECIAL_IDS),
    "encode_words_shuffled_special_ids": query(document_ids(q.LENGTH - 2), SPECIAL_IDS),
    "truncate": query(document_ids(), f"select doc_id, {text_of('ids')} as ids from encoded"),
    "pad_max_length": query(
        document_ids(LONGEST),
        f"select doc_id, {text_of(f'list_concat({filled(PAD_ID, f"{LONGEST} - len(ids)")}, ids)')} as pad_left,"
        f" {text_of(padded(LONGEST))} as pad_right from encoded",
    ),
    "pad_longest": query(
        {
            **PROMPTS_V2,
            **encoded("prompts", "prompt", "ex_id, copy_id", q.VOCAB, q.LENGTH),
            "places": places("copies", 1),
            "batches": batch_places("places", 4, 2, 1),
            "grouped": """
                select e.ex_id, e.copy_id, ids, max(len(ids)) over (partition by epoch, rank, micro) as longest
                from encoded e join batches b on e.ex_id = b.ex_id and e.copy_id = b.copy_id""",
        },
        f"select ex_id, copy_id, {text_of(padded('longest'))} as input_ids,"
        f" {text_of(masked('longest'))} as attention_mask from grouped",
    ),
    "attention_mask": query(
        document_ids(LONGEST),
        f"select doc_id, {text_of(f'list_concat({filled(0, f"{LONGEST} - len(ids)")}, {filled(1, "len(ids)")})')}"
        f" as mask_left, {text_of(masked(LONGEST))} as mask_right from encoded",
    ),
    "mask_labels": query(
        document_ids(LONGEST), f"select doc_id, {text_of(labelled(padded(LONGEST)))} as labels from encoded"
    ),
    "pad_token_fallback": query(
        {
            **document_ids(LONGEST),
            "ended": f"select doc_id, list_concat(ids, [{EOS_ID}]) as ids from encoded",
        },
        f"select doc_id, {finished(LONGEST + ' + 1', EOS_ID)} from ended",
    ),
    "augment_report": query(
        COPIES,
        "select count(*) filter (copy_id = 0) as rows_before, count(*) as rows_after from copies",
    ),
    "train_test_split": query(
        {**COPIES, "marked": split_cte()},
        "select c.ex_id, c.copy_id, split from copies c join marked m on c.ex_id = m.ex_id",
    ),
    "train_test_split_by_hash": query(
        COPIES,
        f"""select ex_id, copy_id,
              case when cast('0x' || substr(md5(concat_ws('|', '{q.SEED}', ex_id)), 1, 8) as bigint)
                     / 4294967296.0::double < cast({q.TEST_SIZE} as double) then 'test' else 'train' end as split
            from copies""",
    ),
    "epoch_shuffle": query(PLACES, "select ex_id, copy_id, epoch, position from places"),
    "epoch_shuffle_equal_rows": query(
        EQUAL_ROWS, "select ex_id, copy_id, epoch, position from places"
    ),
    "renumber_equal_rows": query(
        EQUAL_ROWS,
        "select row_number() over (order by copy_id, ex_id nulls first) - 1 as row_index, ex_id, copy_id from copies",
    ),
    "train_test_split_equal_rows": query(
        {"marked": split_cte("documents", "source")},
        "select doc_id, d.source, split from documents d join marked m on d.source is not distinct from m.source",
    ),
    "assign_batches": query(PLACES, "select ex_id, copy_id, epoch, rank, micro, step, slot from batches"),
    "collate_causal_lm": query(
        {
            **IDS,
            "places": places("copies"),
            "batches": batch_places("places"),
            "ready": f"""
                select b.*, {padded(q.LENGTH)} as padded_ids, {masked(q.LENGTH)} as mask
                from batches b join encoded e on b.ex_id = e.ex_id and b.copy_id = e.copy_id""",
        },
        f"""select epoch, step, micro, rank,
                   {text_of('list(ex_id order by slot)')} as ex_id,
                   {text_of('list(copy_id order by slot)')} as copy_id,
                   {text_of('flatten(list(padded_ids order by slot))')} as input_ids,
                   {text_of('flatten(list(mask order by slot))')} as attention_mask,
                   {text_of(labelled('flatten(list(padded_ids order by slot))'))} as labels
            from ready group by epoch, step, micro, rank""",
    ),
    "prepare_dataset_v1": query(
        IDS_V1, f"select ex_id, copy_id, {finished(q.LENGTH, labels=False)} from encoded"
    ),
    "tensor_shards": query(
        {
            **IDS,
            "places": places("copies"),
            "placed": "select e.*, epoch, position from places p"
            " join encoded e on p.ex_id = e.ex_id and p.copy_id = e.copy_id",
        },
        f"""select epoch, position, copy_id, row_number() over (order by epoch, position) - 1 as place,
                   {finished(q.LENGTH)} from placed""",
    ),
    "prepare_dataset_v2": query(IDS, f"select ex_id, copy_id, {finished(q.LENGTH)} from encoded"),
    "prepare_dataset_v2_literal_nan": query(
        LITERAL_NAN, f"select ex_id, copy_id, {finished(q.LENGTH)} from encoded"
    ),
    "prepare_dataset_v2_from_csv": query(
        FROM_CSV, f"select ex_id, copy_id, {finished(q.LENGTH)} from encoded"
    ),
}
