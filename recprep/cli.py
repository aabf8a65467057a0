"""Command line: ``python -m recprep.cli <command> --data-dir D --out-dir O``.

Commands mirror the reference's scripts: ``ranking-prep`` (features,
train/eval example parts in Parquet or TFRecord) and ``sequence-prep``
(BERT-style train windows and eval candidate sets). Settings come from the
command's section of a TOML file (``--config``) and from ``--set name=value``,
which wins; an unknown name is an error. The session comes from
``spark-submit`` settings; a local master is used only when none is set.
"""

from __future__ import annotations

import argparse
import inspect
import json
import tomllib

from recprep.session import get_session


def _prepare(command: str):
    if command == "ranking-prep":
        from recprep.plans.ranking import prepare_ranking_dataset
        return prepare_ranking_dataset
    from recprep.plans.sequences import prepare_sequence_dataset
    return prepare_sequence_dataset


def settings(command: str, config: str | None = None, given: list[str] = ()) -> dict:
    """Keyword arguments of the command's plan: its section of the TOML file,
    then ``name=value`` pairs (TOML values; anything else is a string)."""
    known = list(inspect.signature(_prepare(command)).parameters)[3:]
    out = {}
    if config:
        with open(config, "rb") as f:
            out.update(tomllib.load(f).get(command, {}))
    for pair in given:
        name, sign, value = pair.partition("=")
        if not sign:
            raise ValueError(f"not a name=value pair: {pair!r}")
        try:
            out[name.strip()] = tomllib.loads(f"v = {value}")["v"]
        except tomllib.TOMLDecodeError:
            out[name.strip()] = value
    unknown = sorted(set(out) - set(known))
    if unknown:
        raise ValueError(f"unknown settings of {command}: {unknown}; known: {known}")
    return out


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="recprep")
    p.add_argument("command", choices=["ranking-prep", "sequence-prep"])
    p.add_argument("--data-dir", required=True)
    p.add_argument("--out-dir", required=True)
    p.add_argument("--config", default=None, help="TOML file with a section per command")
    p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", dest="given")
    p.add_argument("--write-format", default=None, choices=["parquet", "tfrecord"])
    p.add_argument("--parts", type=int, default=None)
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    chosen = settings(a.command, a.config, a.given)
    if a.parts:
        chosen["n_parts"] = a.parts
    if a.write_format and a.command == "ranking-prep":
        chosen["write_format"] = a.write_format
    spark = get_session(a.master)
    print(json.dumps(_prepare(a.command)(spark, a.data_dir, a.out_dir, **chosen)))


if __name__ == "__main__":
    main()
