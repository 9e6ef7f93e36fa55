import xxhash

from cardtide.llm.ngrams import WordHashes


def test_word_memo_stays_small_and_exact():
    memo = WordHashes()
    words = [b"w%07d" % i for i in range(120_000)]
    got = [memo[w] for w in words]
    assert got == [xxhash.xxh64_intdigest(w) for w in words]
    assert len(memo) <= 50_000
