"""The label vocabulary: which attributes exist and which options each one has.

Everything downstream (result schema, score layout, prompts) is derived from a
`Vocabulary`, so adding an attribute means passing a different one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The default attributes and their options, in reporting order.
ATTRIBUTE_OPTIONS: dict[str, tuple[str, ...]] = {
    "Age": ("child", "teen", "young adult", "middle-aged", "elderly"),
    "Gender": ("male", "female", "non-binary"),
    "Ethnicity": ("Asian", "African", "Caucasian", "Hispanic", "Middle Eastern"),
    "Hair_Style": ("straight", "curly", "wavy", "ponytail", "bun", "braided"),
    "Hair_Color": ("black", "brown", "blonde", "red", "white", "gray", "colorful"),
    "Hair_Length": ("bald", "short", "medium", "long"),
    "Eye_Color": ("brown", "blue", "green", "gray", "hazel", "amber"),
    "Body_Type": ("slim", "average", "muscular", "curvy", "heavy"),
    "Dress": ("casual", "formal", "traditional", "uniform", "fantasy", "modern"),
}

# The attributes that are read from text, and their options there.
TEXT_ATTRIBUTE_OPTIONS: dict[str, tuple[str, ...]] = {
    "Age": ("child", "teen", "young adult", "middle-aged", "elderly"),
    "Gender": ("male", "female", "non-binary"),
    "Hair_Color": ("black", "brown", "blonde", "red", "white", "gray", "colorful"),
    "Eye_Color": ("brown", "blue", "green", "gray", "hazel"),
}

# An option wins only above this probability; prompt wording.
CONFIDENCE_THRESHOLD = 0.3
PROMPT_TEMPLATE = "a {option} person"


@dataclass(frozen=True)
class Attribute:
    """One attribute and the slice of the score array that belongs to it."""

    name: str
    options: tuple[str, ...]
    start: int

    @property
    def stop(self) -> int:
        return self.start + len(self.options)


class Vocabulary:
    """Ordered attributes; option `i` of all options owns score cell `i`."""

    def __init__(self, options: dict[str, tuple[str, ...] | list[str]]):
        self.attributes: list[Attribute] = []
        start = 0
        for name, values in options.items():
            if not values:
                raise ValueError(f"attribute {name!r} has no options")
            self.attributes.append(Attribute(name, tuple(values), start))
            start += len(values)
        self.size = start

    @property
    def names(self) -> list[str]:
        return [a.name for a in self.attributes]

    @property
    def schema(self) -> T.StructType:
        """One nullable string per attribute."""
        return T.StructType([T.StructField(n, T.StringType(), True) for n in self.names])

    def rows(self) -> list[tuple[str, int, str, int, int, str]]:
        """(attribute, attr_idx, option, opt_idx, ordinal, prompt) per option."""
        return [
            (a.name, i, option, j, a.start + j, PROMPT_TEMPLATE.format(option=option))
            for i, a in enumerate(self.attributes)
            for j, option in enumerate(a.options)
        ]

    def frame(self, spark):
        """The vocabulary as a DataFrame; its size is the vocabulary's, not the data's."""
        return spark.createDataFrame(
            self.rows(),
            "attribute string, attr_idx int, option string, opt_idx int, ordinal int, prompt string",
        )


IMAGE_VOCABULARY = Vocabulary(ATTRIBUTE_OPTIONS)
TEXT_VOCABULARY = Vocabulary(TEXT_ATTRIBUTE_OPTIONS)
