"""Fixed values of the checked queries' SQL, written out here apart from the operators, so that a wrong one in either shows."""

# fmt: off
SEGMENT_TERMS = ("sma", "ema", "rsi", "macd", "ta.", "close", "open", "high", "low", "volume", "strategy", "input", "threshold")
SEGMENT_CODE = ("=", "ta.", "input.", "strategy.", "(", ")", "*", "+", "-")
SEGMENT_NAMES = ("threshold", "signal", "entry", "exit", "period", "length")
GENERIC = ("this strategy uses", "the strategy", "it uses", "based on")
SPECIFIC = ("200-day", "sma", "moving average", "crossover", "threshold", "signal", "entry", "exit")
CODE_FUNCTIONS = ("ta.sma", "ta.ema", "ta.rsi", "ta.macd", "ta.stoch", "strategy.entry", "strategy.close", "strategy.exit", "plot", "plotshape", "label.new", "line.new")
STRATEGY_FUNCTIONS = (*CODE_FUNCTIONS, "ta.atr", "plotchar")
TRADING = ("bt.", "backtrader", "strategy", "indicator", "signal")
RISKS = ("risk", "stop loss", "position size", "drawdown")
LOGIC = ("because", "therefore", "since", "as a result", "consequently")
EXPLAIN = ("strategy", "approach", "method", "technique", "algorithm")
GROUPS = (
    ("entry", "buy", "long", "signal"),
    ("exit", "sell", "short", "close"),
    ("stop", "loss", "risk", "drawdown", "position_size"),
    ("sma", "ema", "rsi", "macd", "bollinger", "vix", "atr"),
    ("backtest", "performance", "sharpe", "returns"),
)
TECHNICAL = ("algorithm", "strategy", "indicator", "signal", "portfolio", "volatility", "momentum", "trend", "support", "resistance", "timeframe", "market", "price", "volume")
FINANCE = ("profit", "loss", "return", "volatility", "sharpe", "drawdown")
NEW = ("novel", "innovative", "unique", "creative", "advanced", "hybrid")
RELEVANT = (
    "sma", "ema", "rsi", "macd", "bollinger", "stochastic", "atr", "adx", "momentum", "williams", "cci", "roc", "trix", "aroon", "vortex",
    "buy", "sell", "signal", "entry", "exit", "stop", "profit", "loss", "position", "trade", "strategy", "backtest", "portfolio", "risk", "return", "equity", "drawdown", "sharpe", "volume", "price",
    "dataframe", "close", "open", "high", "low", "volume", "date", "pandas", "numpy", "bt", "backtrader", "zipline", "pyfolio",
    "def", "class", "import", "return", "if", "for", "while", "calculate", "compute", "analyze", "indicator", "signal",
)
FORMULA = r"\d+\s*[+\-*/]\s*\d+|[a-zA-Z]\s*[+\-*/=]\s*[a-zA-Z0-9]"
DOCSTRING = r'(?s)""".*?"""|' + r"(?s)'''.*?'''"
NAME = r"\b[a-z_][a-z0-9_]*\b"
NOTES = ("note:", "note that", "if the price of", "deleverage", "protect yourself")
CODE_SIGNS = ("=", "(", ")", ".", "ta.", "close", "open", "high", "low", "sma", "ema", "rsi")
CODE_SHAPES = (r"(?i)=\s*[^=]", r"(?i)\w+\s*\(", r"(?i)\b(if|while|for|function|def|var|let|const|input\.)\b", r"(?i)\w+\.\w+", r"(?i)\[.*\]")
NOTE_ONLY = r"(?is)^\s*Note:\s*\(.*\)\s*$"
STRATEGY, INDICATOR = r"(?i)\bstrategy\s*\(|@strategy", r"(?i)\bindicator\s*\(|@indicator"
ORDER_CALL = r"(?i)strategy\.(entry|order|exit|close)"
PLOTS = r"(?i)\b(plot|plotshape|plotchar|plotarrow|hline|bgcolor|barcolor|fill|line\.new|box\.new|label\.new)\s*\("
ORDERS = r"(?i)\b(strategy\.entry|strategy\.order|strategy\.exit|strategy\.close|strategy\s*\()"
DRAWING_LINE = r"(?i)^\s*((p_\w+\s*=\s*plot|plot|plotshape|plotchar|plotcandle|plotbar|hline|fill|bgcolor|label\.new|label\.set_\w+|table\.new|table\.cell|box\.new|line\.new)\s*\(|//\s*===.*(plot|visual|label|draw))"
PLOT_CALL = r"\b(plot|hline|plotshape|plotchar|plotarrow|bgcolor|barcolor|fill)\s*\("
FOREIGN = r"[\x{4E00}-\x{9FFF}\x{3040}-\x{309F}\x{30A0}-\x{30FF}\x{AC00}-\x{D7AF}\x{0400}-\x{04FF}\x{0600}-\x{06FF}\x{0E00}-\x{0E7F}]"
THEMES = (
    ("complex_indicators", ("divergence", "multiple indicators")),
    ("multi_timeframe", ("timeframe", "multi-frame")),
    ("risk_management", ("risk", "money management")),
    ("machine_learning", ("machine learning", "ai")),
    ("unusual_patterns", ("moon", "unusual", "experimental")),
)
BUCKETS = (
    ("complex_indicators", ("divergence", "multiple indicators", "combine", "blend")),
    ("multi_timeframe", ("timeframe", "multi-frame", "htf", "higher timeframe")),
    ("risk_management", ("risk management", "position sizing", "money management")),
    ("machine_learning", ("machine learning", "neural", "ai", "algorithm")),
    ("unusual_patterns", ("moon phase", "unusual", "experimental", "novel")),
)
SHARED_KEYWORDS = ("strategy", "indicator", "input", "plot", r"ta\.", r"math\.", r"request\.", "security")
LENGTH_EDGES = (0, 50, 100, 200, 500, 1000, 2000)
# fmt: on
