"""Fixed values.

Every name below has to keep exactly these entries for results to agree with
existing corpora, ledgers and endpoints: language tables, closed label lists,
regular expressions, formats and limits.  Nothing here is logic.
"""

# ISO code, English name, Chinese name, NLLB code.
LANGUAGES = [
    ("zh-cn", "Chinese", "中文", "zho_Hans"),
    ("en", "English", "英语", "eng_Latn"),
    ("es", "Spanish", "西班牙语", "spa_Latn"),
    ("ja", "Japanese", "日语", "jpn_Jpan"),
    ("ko", "Korean", "韩语", "kor_Hang"),
    ("th", "Thai", "泰语", "tha_Thai"),
    ("ar", "Arabic", "阿拉伯语", "arb_Arab"),
    ("de", "German", "德语", "deu_Latn"),
    ("fr", "French", "法语", "fra_Latn"),
    ("it", "Italian", "意大利语", "ita_Latn"),
    ("ru", "Russian", "俄语", "rus_Cyrl"),
    ("pt", "Portuguese", "葡萄牙语", "por_Latn"),
    ("id", "Indonesian", "印尼语", "ind_Latn"),
    ("hi", "Hindi", "印地语", "hin_Deva"),
    ("te", "Telugu", "泰卢固语", "tel_Telu"),
    ("ta", "Tamil", "泰米尔语", "tam_Taml"),
    ("ur", "Urdu", "乌尔都语", "urd_Arab"),
    ("vi", "Vietnamese", "越南语", "vie_Latn"),
    ("ms", "Malay", "马来语", "zsm_Latn"),
    ("no", "Norwegian", "挪威语", "nob_Latn"),
    ("sv", "Swedish", "瑞典语", "swe_Latn"),
    ("fi", "Finnish", "芬兰语", "fin_Latn"),
    ("da", "Danish", "丹麦语", "dan_Latn"),
    ("nl", "Dutch", "荷兰语", "nld_Latn"),
    ("ca", "Catalan", "加泰罗尼亚语", "cat_Latn"),
    ("he", "Hebrew", "希伯来语", "heb_Hebr"),
    ("el", "Greek", "希腊语", "ell_Grek"),
    ("hu", "Hungarian", "匈牙利语", "hun_Latn"),
    ("pl", "Polish", "波兰语", "pol_Latn"),
    ("cs", "Czech", "捷克语", "ces_Latn"),
    ("sk", "Slovak", "斯洛伐克语", "slk_Latn"),
    ("ro", "Romanian", "罗马尼亚语", "ron_Latn"),
    ("sl", "Slovenian", "斯洛文尼亚语", "slv_Latn"),
    ("hr", "Croatian", "克罗地亚语", "hrv_Latn"),
    ("bg", "Bulgarian", "保加利亚语", "bul_Cyrl"),
    ("tr", "Turkish", "土耳其语", "tur_Latn"),
    ("uk", "Ukrainian", "乌克兰语", "ukr_Cyrl"),
    ("is", "Icelandic", "冰岛语", "isl_Latn"),
    ("fil", "Filipino", "菲律宾语", "fil_Latn"),
    ("sw", "Swahili", "斯瓦希里语", "swh_Latn"),
    ("mn", "Mongolian", "蒙古语", "khk_Cyrl"),
    ("fa", "Persian", "波斯语", "pes_Arab"),
    ("kk", "Kazakh", "哈萨克语", "kaz_Cyrl"),
    ("uz", "Uzbek", "乌兹别克语", "uzn_Latn"),
]

# The two extra labels an answer may carry besides languages.
ANNOTATION_LABELS = [("style", "Style"), ("scene", "Scene")]

# Speaking styles and scenes a request offers.
STYLES = [
    "sad", "chat", "calm", "angry", "sorry", "gentle", "serious", "fearful",
    "excited", "envious", "lyrical", "hopeful", "cheerful", "newscast",
    "friendly", "shouting", "depressed", "terrified", "assistant",
    "unfriendly", "whispering", "empathetic", "disgruntled", "embarrassed",
    "chat-casual", "conversation", "affectionate", "poetry-reading",
    "livecommercial", "newscast-formal", "customerservice", "newscast-casual",
    "sports-commentary", "narration-relaxed", "advertisement-upbeat",
    "documentary-narration", "narration-professional",
    "sports-commentary-excited",
]
SCENES = [
    "chat-casual", "conversation", "livecommercial", "sorry", "speech",
    "broadcast", "interviews",
]

# Languages of the eleven-column corpus, and those of them whose
# text gets cleaned.
CORPUS_LANGS = ["zh-cn", "en", "ja", "ko", "es", "th", "de", "fr", "it", "ru", "ar"]
CLEANED_LANGS = ["zh-cn", "en", "ja", "ko", "es", "th", "ru", "ar"]

# Words removed from translated sentences.
SENTENCE_LABELS = [
    "中文", "英文", "西班牙文", "日文", "韩文", "泰文", "阿拉伯文", "中(简体)",
    "西班牙语", "西语", "日语", "韩语", "英语", "泰语", "阿拉伯语",
    "Chinese", "English", "Spanish", "Japanese", "Korean", "Arabic", "Thai",
    "Chinese (中文)", "Spanish (Español)", "Japanese (日本語)",
    "Korean (한국어)", "Thai (ไทย)", "Arabic (ﺎﻠﻋﺮﺒﻳﺓ)",
    "Chinese (Simplified)", "Español (Spanish)", "日本語 (Japanese)",
    "한국어 (Korean)", "ไทย (Thai)", "ﺎﻠﻋﺮﺒﻳﺓ (Arabic)", "translation:",
]

# Labels that open a line of a raw block.
LINE_LABELS = [
    "中文：", "英文：", "西班牙文：", "日文：", "韩文：", "泰文：", "阿拉伯文：",
    "中(简体)：",
    "- 中文：", "- 英文：", "- 西班牙文：", "- 日文：", "- 韩文：", "- 泰文：",
    "- 阿拉伯文：",
    "中文:", "英文:", "西班牙文:", "日文:", "韩文:", "泰文:", "阿拉伯文:",
    "西班牙语：", "日语：", "韩语：", "英语：", "泰语：", "阿拉伯语：",
    "西班牙语:", "日语:", "韩语:", "英语:", "泰语:", "阿拉伯语:",
    "Chinese (中文):", "English:", "Spanish (Español):", "Japanese (日本語):",
    "Korean (한국어):", "Thai (ไทย):", "Arabic (ﺎﻠﻋﺮﺒﻳﺓ):",
    "Chinese:", "Spanish:", "Japanese:", "Korean:", "Arabic:", "Thai:",
    "Chinese (Simplified):", "Español (Spanish):", "日本語 (Japanese):",
    "한국어 (Korean):", "ไทย (Thai):", "ﺎﻠﻋﺮﺒﻳﺓ (Arabic):",
]

# Phrases marking boilerplate lines, and phrases that end a block.
BOILERPLATE_PHRASES = ["平行语料", "ai language model", "parallel corpus"]
APOLOGY_PHRASES = ["请注意", "很抱歉"]
BLOCK_MARKER = "test48:"
RECORD_MARK = "[_mark_]"

# White space, as the body of a character class and as characters.
# (Listing it is many times faster than a Unicode property in a regex.)
SPACE = r" \t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Patterns of the sentence cleaner (Java syntax; {s} is white space).
CLEAN_ECHO = r"(?i)Provide the translation"
CLEAN_BRACKETED = r"(?i)\(.*?transla.*?\)"
CLEAN_URL = r"https://[^{s}]+"
CLEAN_ZH_BRACKETED = r"\(.*?翻译.*?\)"
CLEAN_ZH_LABEL = r"中：|中文：|- 中文：|中:|中文:|- 中文:"
CLEAN_JA_LABEL = r"日：|日文：|- 日文：|日:|日文:|- 日文:|日语|日语:|日语："
CLEAN_HAN_RUN = r"[\(\)（）\-：:{s}]*[一-鿿]+[\(\)（）\-：:{s}]*"
CLEAN_TRANSLATION_REMARK = r"(?i)[\x00-\x7F]*translat[\x00-\x7F]*[.!?。！？]"
CLEAN_LEADING = r"^[）:)\.：\-]+"
CLEAN_TRAILING_NAME = (
    r"\((Chinese|English|Japanese|Korean|Spanish|Thai|German|French|Italian|Russian|Arabic)\)$"
)

# Other character classes and patterns (Java syntax).
HAN = r"一-鿿"
BOLD_LABEL = r"\*\*(.*?):\*\*"
ANNOTATION_DROP = r"[^a-zA-Z0-9,\s]"
MATCH_PUNCTUATION = r"，。？！,.?!\-\"'"
MATCH_PUNCTUATION_CHARS = "，。？！,.?!-\"'"
SEARCH_PUNCTUATION = r"\p{P}，。,.!?！？；;:、"
GLUED_PUNCTUATION = r"^[，。！？；：]"
ALLOWED_PUNCTUATION = ["，", "。", "！", "？"]
SENTENCE_BREAK = r"(?<=[.!?\n]) +"
CLAUSE_TAIL = "，。；;,.!！：:"
CLAUSE_SENTENCE_MARK = "。"
CLAUSE_PHRASE_MARK = "，"
CLOSING_QUOTE = "”"
SST_STEP = r"(?s)(?:- )?\[已累积的原文内容\]：(.*?)\n(?:- )?\[已口播译文\]：(.*?)(?:\n|$)"
SST_LONE_MARKS = [",", ".", "。", "，"]
LOG_LINES = r"Processed (\d+)/"
LOG_PROMPT_TOKENS = r"Total prompt tokens:\s(\d+)"
LOG_FILE = r"([^/]+\.json)"
FILE_NUMBER = r"_(\d+)\."

# Limits.
CLAUSE_LIMIT = 100
PACK_LIMIT = 400
SHARD_ROWS = 49_999
SHARD_BYTES = 99 * 1024 * 1024
VOCABULARY_SIZE = 5000
OUT_OF_VOCABULARY_RATIO = 0.2
MAX_EDITS = 3
MIN_BLOCK_LINES = 7
MIN_BLOCK_LANGS = 4
FILES_PER_TASK = 50
TOPICS_PER_FILE = 1000
FIRST_BACKOFF_SECONDS = 0.3
LOCAL_ZONE = "Asia/Shanghai"
LOCAL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LEDGER_TIME_FORMAT = "yyyy-MM-dd HH-mm-ss"
