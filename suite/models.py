"""Plain functions that stand in for a speech model in the queries."""

import numpy as np


def open_length_model():
    """One silent sample per character; refuses 16 kHz references."""

    def speak(text, samples, rate):
        if rate == 16000:
            raise ValueError(f"unsupported rate {rate}")
        return np.zeros(len(text), dtype=np.float32), 24000

    return speak


def open_prompt_model():
    """One silent sample per character of the prompt; refuses Spanish."""

    def speak(prompt, lang):
        if lang == "es":
            raise ValueError(f"unsupported language {lang}")
        return np.zeros(len(prompt), dtype=np.float32), 24000

    return speak


def open_text_model():
    return lambda text, *rest: (np.zeros(len(text), dtype=np.float32), 24000)


def open_quarter_model():
    """A constant sample of a quarter per character."""
    return lambda text, *rest: (np.full(len(text), 0.25, dtype=np.float32), 24000)


def open_peak_encoder():
    """A code per sample, by its size; refuses clips of the lower rate."""

    def encode(samples, rate):
        if rate == 16000:
            raise ValueError(f"unsupported rate {rate}")
        return np.floor((samples.astype(np.float64) + 1) * 1000).astype(np.int64)

    return encode
