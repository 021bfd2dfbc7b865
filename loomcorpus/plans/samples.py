"""Literal rows that queries take besides the test tables, so that each rule rejects some and each step changes some."""

#: (id, text): texts that rules reject and steps change; the test tables hold hardly any.
TEXTS = [
    "Is this the right way to call it?",
    "How do we call this function from here",
    "What's the use of this one, then",
    "todo write the rest of this text",
    "FIXME broken since the last release",
    "NOT YET DOCUMENTED but soon to be",
    "Missing any Description of the thing",
    "Copyright of somebody, all rights kept",
    "@generated by the protocol compiler today",
    "This method was generated by a tool",
    "auto-generated code, do not change it",
    "1234 5678 9012 3456 (77) [88] 99",
    "!! ?? ### $$$ %%% &&& *** --- +++ ===",
    "(((( one )))) [[[[ two ]]]] {{{{ ((( three",
    "aaaa aaab abab aaaa bbbb",
    "word word word and word again word",
    "my_var other_var third_var is_set here",
    "camelCase otherCamel ThirdCamelCase XmlNames used",
    "obj.call(x) then foo.bar(y) and baz.qux(z)",
    "this IS A VERY LOUD TEXT WITH MANY CAPITALS IN IT RIGHT HERE NOW",
    "this HAS FILE_NAME AND HH:MM:SS AND MANY CAPITALS IN IT RIGHT HERE NOW",
    "abcdefghijklmnopqrstuvwxyzabcdefghijklmno is long",
    "see https://example.org/path(x) for more details",
    "www.example.com has the details of it",
    "two words",
    "   ",
    "café au lait is not ascii at all",
    "Computes \\log(x) = y : mathbf x > y < z >= w / v * u + t",
    "HH:MM:SS is how times are written in here",
    "DD-MM-YY or YYYY-MM-DD are dates in the text",
    "R,G,B values, or r-g-b, of a colour in this picture",
    "Adds (see other) the numbers <http://x.y/z> together (e.g. one).",
    "Title\n=\n - \n*\ntext below the rulers",
    "*framed line*\n plain line \n=another framed=\n/x/\n_y_",
    "add_one(x): adds one to the number",
    "name - does what its name says here",
    "Does a thing with it e.g. like this and that",
    "Does it all for you. Note: not always as said",
    "Sorts the list in place Example: sort([1])",
    "Ends with a colon:",
    "Ends with a semicolon;",
    "at sign at the very end@",
    "First of all. See https://x.y/z for more. Last one.",
    "/** A comment with <code>code</code> inside */",
]
#: (name, comment) pairs, some of which say no more than the name.
NAMES = [("getUserName", "get user name"), ("parse_http2Response", "Parse http 2 response"), ("close", "Closes the file and gives its handle back"), ("setValue", "set the value"), ("x", "y")]

_PYTHON = '''import os

def total_price(items, rate: float = 0.2):
    """Sums the prices of all items.

    Args:
        items (list): the items that are bought
        extra: not declared anywhere in here

    Returns:
        float: the price of all items together

    Raises:
        ValueError: if an item has no price
    """
    # start from nothing
    total = 0
    for item in items:
        total += item.price
    # add the tax
    # to the sum
    if rate:
        total *= 1 + rate
    return total


def get_rate():
    return 0.2


class Basket(Store, list):
    """What somebody wants to buy."""

    def is_full(self):
        return len(self) > 99 or self.closed
'''
_GO = "package a\n\n// Add adds the numbers.\n// It never fails.\nfunc Add(a int, b int) int {\n\tx := a\n\t// and the other\n\ty := b\n\treturn x + y\n}\n"
_JAVA = 'class A {\n  /**\n   * Adds two numbers to each other.\n   * @param a the first of the numbers\n   * @return the sum of both numbers\n   */\n  public int add(int a, List<String> b) {\n    String s = "}";\n    int c = a + 1;\n    return c;\n  }\n}\n'
_SCRIPT = "/** Joins the names.\n * @param {string} first - the name that comes first\n * @returns {string} both of the names together\n */\nfunction join(first, last) {\n  const gap = ' ';\n  const all = first + gap;\n  return all + last;\n}\n"
_RUBY = "# Counts the words of a text.\ndef count_words(text)\n  n = 0\n  text.split.each do |w|\n    n += 1 # one more\n  end\n  n\nend\n"
_RUST = "/// Doubles the number given.\npub fn double(n: i32) -> i32 {\n    let a = n;\n    let b = n;\n    a + b\n}\n"
#: (path, language, code) files; one of them is broken, and one in a language that isn't read.
FILES = [("a.py", "Python", _PYTHON), ("a.go", "go", _GO), ("A.java", "java", _JAVA), ("a.js", "javascript", _SCRIPT), ("a.rb", "ruby", _RUBY), ("a.rs", "rust", _RUST), ("bad.py", "python", "def broken(:\n  pass"), ("a.cob", "cobol", "x"), ("none.py", "python", None)]
#: Comments as they stand in code, for the cleaning steps.
COMMENTS = [
    "/* 将JSONArray转换为Bean的List, 默认为ArrayList */",
    "// TODO: Why is he using Math.round?",
    "// public String transformTypeID(URI typeuri){",
    "/* Do we need to show the upgrade wizard prompt? */",
    "/* fixme: This function is not in use */",
    "Returns the surface (e.g. it's a software surface) of it.",
    "--------\nPrints {@code the value} of it (i.e. all of it)",
    "* first line here\n* second line there",
    "***** Starts the engine *****",
    "=====\nLoads the file:",
    "sort_all(): Sorts the list of names;",
    "Keeps this sentence. Is this one kept? And this one isn't.",
    "Returns &lt;b&gt; of <b>all</b> values there.",
    "",
]
#: (id, docstring, code) pairs for a model that keeps those which share a word.
PAIRS = [(1, "adds the numbers", "x = numbers + 1"), (2, "closes the file", "f.open()"), (3, None, "x"), (4, "", ""), (5, "open it", "f.open()")]
