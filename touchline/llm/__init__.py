"""Training-data operators: archives, de-duplication, decontamination, privacy, packing and token output.

Nothing outside this subpackage imports it. Each operator is a function from DataFrames to a
DataFrame; ``touchline.llm.registry`` lists the registered queries.
"""
