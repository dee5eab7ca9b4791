"""Figures of an executed plan."""


def _nodes(node):
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _nodes(node.executedPlan())
        return
    if kind.endswith("QueryStageExec"):
        yield from _nodes(node.plan())
        return
    yield kind, node
    children = node.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def executed(df):
    """[(node's kind, node)] of a table that was collected."""
    return list(_nodes(df._jdf.queryExecution().executedPlan()))


def shuffled(df, metric="shuffleBytesWritten"):
    """What all exchanges of a collected table wrote."""
    return sum(node.metrics().apply(metric).value() for kind, node in executed(df)
               if kind == "ShuffleExchangeExec")
