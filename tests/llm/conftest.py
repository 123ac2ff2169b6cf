import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import empty, labels, odd  # noqa: E402, F401
