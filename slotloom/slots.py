"""The fixed schema of a template: slot names and the text that marks "no value"."""

# Slot names in the order a template lists them.
SLOTS = ("acquired", "acqbus", "acqloc", "dlramt", "purchaser", "seller", "status")

# Fixed value: how a template file writes an empty slot.
NO_VALUE = "---"

# Label of a training row that fills no slot.
NO_SLOT = "none"

# Entity label of a candidate that is not a named entity.
NO_ENTITY = "nonent"
