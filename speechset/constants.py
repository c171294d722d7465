"""Names, ranges, formats and texts that results depend on."""

# Speaker ranges (split, first index, last index, speaker number, name), inclusive.
SPEAKER_RANGES = [
    ("dev", 0, 106, 1, "Elena"),
    ("dev", 107, 188, 2, "Antoine"),
    ("dev", 189, 254, 3, "Michał"),
    ("dev", 255, 362, 4, "Jiawei"),
    ("dev", 363, 467, 5, "Bhargavi"),
    ("eval", 0, 99, 6, "Allan"),
    ("eval", 100, 183, 7, "Antoine_MUV"),
    ("eval", 184, 239, 8, "Letitia"),
    ("eval", 240, 329, 9, "Kamezawa"),
    ("eval", 330, 415, 10, "Asaf"),
]
UNKNOWN_SPEAKER_ID = "speaker_unknown"
UNKNOWN_SPEAKER_NAME = "Unknown"

# Display names of the synthesis languages.
LANGUAGE_NAMES = {
    "en": "English",
    "es": "Spanish",
    "de": "German",
    "fr": "French",
    "vi": "Vietnamese",
    "it": "Italian",
    "zh": "Chinese",
    "hi": "Hindi",
    "ja": "Japanese",
}

# Built-in voices and their model ids.
VOICE_IDS = {"John": 0, "Sofia": 1, "Aria": 2, "Jason": 3, "Leo": 4}

# Languages of the multilingual source, and those the synthesis model shares with it.
CORPUS_LANGUAGES = ["en", "ar", "de", "fa", "fr", "ja", "nl", "pt", "ru", "tr", "zh"]
SHARED_LANGUAGES = ["en", "de", "fr", "ja", "zh"]

# Error texts of the two input checks.
ERROR_NO_AUDIO = "missing or empty source audio"
ERROR_NO_TEXT = "missing French text"

# Metadata file names, best first.
METADATA_CANDIDATES = [
    "metadata_cloned.csv",
    "metadata_enhanced.csv",
    "metadata_fr_test.csv",
    "metadata.csv",
]

# Words that mark a column as audio ("auido" is a known misspelling in old files).
AUDIO_NAME_PARTS = ["audio", "voice", "auido"]

# Codec and prompt markers.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
SPEECH_START = "<|speech_start|>"
CODE_PREFIX = "<|s_"
CODE_SUFFIX = "|>"
CODE_PATTERN = r"<\|s_(\d+)\|>"

# Sampling rates, prompt guard and defaults.
CODEC_INPUT_RATE = 16000
OUTPUT_RATE = 24000
DEFAULT_FILE_RATE = 22050
PROMPT_TOKEN_LIMIT = 8000
PROMPT_SECONDS = 3
CFG_FLOOR = 0.001
TEST_SPEAKERS = 2
SAMPLE_SEED = 0
SAMPLE_ROWS = 100
SENTENCES_PER_LANGUAGE = 10
PREVIEW_CHARS = 60

# Columns of the clip record, in order.
CLIP_COLUMNS = [
    "_key",
    "speaker_id",
    "speaker_name",
    "original_split",
    "original_index",
    "text_en",
    "text_fr",
    "audio_en",
    "cloned_audio_fr",
    "error",
]
