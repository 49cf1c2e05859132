"""Checks of run configurations before anything is read or written: which flow may use which folders and devices."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any


@dataclass(frozen=True)
class Flow:
    """The rules of one flow."""

    local: bool
    chat: bool
    #: setting -> the folders it must lie in (any of them); a setting that ends with ? may be missing.
    folders: Mapping[str, tuple[str, ...]]
    vocabulary: tuple[int, int | None]


#: The folders and vocabulary sizes of the four flows.
FLOWS = {
    "local": Flow(True, False, {"data_dir": ("./data/local_smoke/",), "output_dir": ("./artifacts/local/",), "logging_dir?": ("./artifacts/local/",)}, (0, 4096)),
    "production": Flow(False, False, {"data_dir": ("./data/production/",), "output_dir": ("./artifacts/production/",), "logging_dir?": ("./artifacts/production/",)}, (10000, None)),
    "local_sft": Flow(True, True, {"data_dir": ("./data/local_smoke/sft/",), "output_dir": ("./artifacts/local/sft/",), "pretrained_model_path": ("./artifacts/local/sft/",), "logging_dir?": ("./artifacts/local/sft/",)}, (0, None)),
    "production_sft": Flow(False, True, {"data_dir": ("./data/production/sft/",), "output_dir": ("./artifacts/production/sft/",), "pretrained_model_path": ("./artifacts/production/",), "logging_dir?": ("./artifacts/production/sft/",)}, (10000, None)),
}


def below(path: str, folder: str) -> bool:
    """Whether a path, links resolved, is a folder or lies in it."""
    inner, outer = os.path.realpath(path), os.path.realpath(folder)
    return inner == outer or inner.startswith(outer.rstrip(os.sep) + os.sep)


def faults(flow: str, train: Mapping[str, Any], model: Mapping[str, Any], also_in: Mapping[str, Sequence[str]] | None = None) -> list[str]:
    """What forbids a run of this flow; nothing if it may start. also_in: more folders that a setting may lie in, by its name."""
    rules, found = FLOWS[flow], []
    said = lambda wrong, what: found.append(what) if wrong else None
    if rules.chat:
        said(not train.get("pretrained_model_path"), "pretrained_model_path is missing")
        said(not train.get("tokenizer_name") and train.get("tokenizer_type") != "toy_chatml", "a tokenizer is missing")
    if rules.local:
        said(train.get("use_cpu") is not True, "a local run uses the CPU")
        said(not rules.chat and train.get("tokenizer_name"), "a local run has no remote tokenizer")
        said(train.get("deepspeed"), "a local run has no distributed configuration")
        said(train.get("resume_from_last_checkpoint") not in (False, None), "a local run starts anew")
    else:
        said(train.get("use_cpu", False), "a production run does not use the CPU")
        said(not train.get("tokenizer_name"), "tokenizer_name is missing")
        said(not train.get("deepspeed"), "a distributed configuration is missing")
        said(train.get("resume_from_last_checkpoint") is not True, "a production run resumes from the last checkpoint")
    for setting, folders in rules.folders.items():
        path = train.get(setting.rstrip("?"))
        if path is None and not setting.endswith("?"):
            said(True, f"{setting} is missing")
        elif path is not None:
            folders = (*folders, *(also_in or {}).get(setting.rstrip("?"), ()))
            said(not any(below(path, f) for f in folders), f"{setting.rstrip('?')} must lie in {' or '.join(folders)}: {path}")
    least, most = rules.vocabulary
    size = model.get("vocab_size")
    if not (flow == "local_sft"):
        said(size is None or size < least or (most is not None and size > most), f"vocab_size {size} is not in the flow's range")
    return found


def check(flow: str, train: Mapping[str, Any], model: Mapping[str, Any], also: Callable[[Mapping, Mapping], None] | None = None, also_in: Mapping[str, Sequence[str]] | None = None) -> None:
    """Raise if a run may not start; `also` is one's own check, `also_in` names more folders for settings."""
    if wrong := faults(flow, train, model, also_in):
        raise ValueError("; ".join(wrong))
    if also:
        also(train, model)


def check_smoke_path(path: str) -> None:
    """Raise unless a smoke run writes into its own folder."""
    if not below(path, "./data/local_smoke/"):
        raise ValueError(f"smoke data belong in ./data/local_smoke/: {path}")
