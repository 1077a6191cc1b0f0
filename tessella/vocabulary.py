"""Fixed vocabularies: types, relations and their schema, labels and lexicons.

All operators take these as parameters; here are the defaults.
"""

from __future__ import annotations

#: Which node types a relation may lead from and to.
RELATION_SCHEMA = {
    "part_of": (("KnowledgeDomain", "KnowledgeUnit", "KnowledgePoint"), ("KnowledgeDomain", "KnowledgeUnit", "KnowledgePoint")),
    "prerequisite_of": (("KnowledgeUnit", "KnowledgePoint"), ("KnowledgeUnit", "KnowledgePoint")),
    "implemented_in": (("KnowledgePoint", "SyntaxRule", "CodeStructure"), ("ProgrammingLanguage",)),
    "has_syntax": (("KnowledgeUnit", "KnowledgePoint"), ("SyntaxRule",)),
    "expresses_concept": (("SyntaxRule",), ("KnowledgePoint",)),
    "has_code_structure": (("KnowledgePoint",), ("CodeStructure",)),
    "has_code_example": (("KnowledgePoint",), ("CodeExample",)),
    "used_in_example": (("SyntaxRule",), ("CodeExample",)),
    "appears_in_example": (("CodeStructure",), ("CodeExample",)),
    "assesses": (("Exercise",), ("KnowledgePoint", "Skill")),
    "requires_skill": (("KnowledgePoint", "Exercise"), ("Skill",)),
    "may_cause": (("KnowledgePoint", "SyntaxRule", "CodeStructure", "Skill"), ("ErrorPattern",)),
    "confused_with": (("KnowledgePoint", "SyntaxRule"), ("KnowledgePoint", "SyntaxRule")),
    "differs_from": (("KnowledgePoint", "SyntaxRule", "ProgrammingLanguage"), ("KnowledgePoint", "SyntaxRule", "ProgrammingLanguage")),
    "inherits_from": (("CodeStructure",), ("CodeStructure",)),
    "implements_interface": (("CodeStructure",), ("CodeStructure",)),
}
#: The node types.
NODE_TYPES = ("KnowledgeDomain", "KnowledgeUnit", "KnowledgePoint", "SyntaxRule", "CodeStructure", "CodeExample", "ProgrammingLanguage", "Exercise", "Skill", "ErrorPattern")
#: How a node type is shown.
SHOWN_NODE_TYPES = {
    "course": ("course", "programmingparadigm", "knowledgedomain"),
    "core": ("oopconcept", "core", "knowledge_node", "knowledgepoint"),
    "practice": ("exercise", "practice", "errorpattern", "codeexample"),
    "topic": ("knowledgeunit", "syntaxrule", "skill"),
    "concept": ("codestructure",),
    "external": ("programminglanguage", "external"),
}
#: How a relation is shown.
SHOWN_EDGE_TYPES = {
    "contains": ("part_of", "belongs_to_paradigm", "contains"),
    "prerequisite": ("prerequisite_of", "prerequisite"),
    "practice": ("assesses", "requires_skill", "demonstrates", "practice", "has_code_example"),
    "external": ("external",),
}
#: Labels of relations; any other is 关联关系.
EDGE_LABELS = {
    "part_of": "包含",
    "contains": "包含",
    "contains_structure": "包含代码结构",
    "has_code_structure": "具有代码结构",
    "has_algorithm": "包含算法",
    "has_algorithm_problem": "包含算法问题",
    "has_algorithm_strategy": "包含算法策略",
    "has_complexity_metric": "具有复杂度指标",
    "has_concurrency_mechanism": "具有并发机制",
    "has_control_structure": "具有控制结构",
    "has_core_concept": "具有核心概念",
    "maps_to_core": "映射到核心概念",
    "has_core_feature": "具有核心特性",
    "has_data_structure": "具有数据结构",
    "has_engineering_practice": "具有工程实践",
    "has_error_handling": "具有异常处理机制",
    "has_implementation_mechanism": "具有实现机制",
    "has_operation_rule": "具有操作规则",
    "has_persistence_mechanism": "具有持久化机制",
    "demonstrates": "演示知识",
    "has_code_example": "示例代码",
    "appears_in_example": "出现于示例",
    "used_in_example": "示例使用",
    "uses_syntax": "使用语法",
    "has_syntax": "具有语法",
    "expresses_concept": "表达概念",
    "implemented_in": "实现于语言",
    "implements_interface": "实现接口",
    "inherits_from": "继承自",
    "prerequisite_of": "前置于",
    "prerequisite": "前置于",
    "belongs_to_paradigm": "属于编程范式",
    "assesses": "考查",
    "requires_skill": "需要技能",
    "may_cause": "可能导致",
    "confused_with": "易与其混淆",
    "equivalent_to": "等价于",
    "differs_from": "区别于",
    "built_on_platform": "构建于平台",
    "develops_ability": "培养能力",
    "solves_problem": "解决问题",
    "supports_language": "支持语言",
    "uses_strategy": "采用策略",
}
#: Node types whose view can be opened.
EXPANDABLE_TYPES = ("Course", "KnowledgeDomain", "KnowledgeUnit", "KnowledgePoint", "AlgorithmStrategy", "OOPConcept")
#: Order of relations that lead to an example.
EXAMPLE_PRIORITY = {"has_code_example": 0, "demonstrates": 1, "uses_syntax": 2, "contains_structure": 3}
#: Order of relations when a view is trimmed.
VIEW_PRIORITY = {"part_of": 0, "demonstrates": 1, "uses_syntax": 2, "contains_structure": 3}
#: Relations between an example and what it uses.
SUPPORT_RELATIONS = ("contains_structure", "uses_syntax", "appears_in_example", "used_in_example")
SUPPORT_TYPES = ("CodeStructure", "SyntaxRule", "ProgrammingLanguage")
#: Spellings of entity types.
TYPE_ALIASES = {
    "知识点": "KnowledgePoint",
    "概念": "KnowledgePoint",
    "编程概念": "KnowledgePoint",
    "concept": "KnowledgePoint",
    "knowledgepoint": "KnowledgePoint",
    "知识单元": "KnowledgeUnit",
    "knowledgeunit": "KnowledgeUnit",
    "知识领域": "KnowledgeDomain",
    "knowledgedomain": "KnowledgeDomain",
    "代码结构": "CodeStructure",
    "类结构": "CodeStructure",
    "方法结构": "CodeStructure",
    "codestructure": "CodeStructure",
    "语法": "SyntaxRule",
    "语法规则": "SyntaxRule",
    "syntaxrule": "SyntaxRule",
    "语言": "ProgrammingLanguage",
    "编程语言": "ProgrammingLanguage",
    "programminglanguage": "ProgrammingLanguage",
    "代码示例": "CodeExample",
    "codeexample": "CodeExample",
    "习题": "Exercise",
    "练习题": "Exercise",
    "exercise": "Exercise",
    "错误模式": "ErrorPattern",
    "errorpattern": "ErrorPattern",
    "能力": "Skill",
    "技能": "Skill",
    "skill": "Skill",
}
#: Question types and difficulties with their labels.
QUESTION_TYPES = {"multiple_choice": "选择题", "true_false": "判断题", "code_reading": "代码阅读题", "code_fixing": "代码改错题", "code_fill": "编程填空题", "short_programming": "简短编程题"}
DIFFICULTIES = {1: "简单", 2: "中等", 3: "较难", 4: "困难", 5: "挑战"}

#: Words that make a text relevant to object orientation, strong and weak ones.
STRONG_KEYWORDS = "面向对象 构造方法 构造函数 封装 继承 多态 抽象类 重载 重写 父类 子类 基类 派生类 this super extends implements override overload inheritance polymorphism encapsulation".split()
WEAK_KEYWORDS = "类 对象 属性 方法 成员变量 接口 抽象 覆盖 class object method field constructor abstract interface private protected public".split()
KEYWORDS = sorted({*STRONG_KEYWORDS, *WEAK_KEYWORDS})
#: Words of pages that give background instead of content.
BACKGROUND = (
    "课程内容 课程安排 课程目标 参考教材 参考文献 java概述 java的历史 历史 发展历程 版本 版本号 java的特征(1) 简单性 基本语法 语法机制概述 数据类型 表达式 程序流控制 jdk jre ide eclipse 安装 环境配置 "
    "sun公司 oracle 平台 虚拟机 字节码 垃圾收集器 helloworld 程序入口点 源文件扩展名 java应用程序举例 java程序的编写 找出并修改下面代码的错误 咨询问题 计算机学院 输入输出 线程 网络程序设计 gui"
).split() + ["james gosling", "hello world", "public static void main"]
#: Words that tell a text's role, in the order that breaks ties.
ROLES = {
    "code_example": ["class ", "public class", "extends ", "implements ", "new ", "void ", "{", "}", ";", "def ", "__init__"],
    "exercise": ["选择题", "填空题", "判断题", "编程题", "下列", "正确的是", "错误的是", "答案", "解析"],
    "syntax_rule": ["语法", "关键字", "使用", "格式", "extends", "implements", "class", "interface"],
    "concept_explanation": ["定义", "概念", "特点", "作用", "表示", "体现", "机制"],
}
#: Spellings of terms, replaced one after the other in this order.
TERMS = (
    ("OOP", "面向对象编程"),
    ("Object-Oriented Programming", "面向对象编程"),
    ("object-oriented programming", "面向对象编程"),
    ("class", "类"),
    ("object", "对象"),
    ("method", "方法"),
    ("field", "属性"),
    ("member variable", "属性"),
    ("constructor", "构造方法"),
    ("inheritance", "继承"),
    ("polymorphism", "多态"),
    ("encapsulation", "封装"),
    ("interface", "接口"),
)
#: Concepts, keywords of the syntax, and the concept a keyword expresses.
CONCEPTS = "类 对象 属性 方法 成员变量 构造方法 构造函数 封装 继承 多态 抽象 抽象类 接口 重载 重写 父类 子类 动态绑定 向上转型 信息隐藏 消息传递 实例化 类型".split()
SYNTAX = "class extends implements interface abstract final public private protected this super new static".split()
SYNTAX_CONCEPTS = {
    "class": "类",
    "extends": "继承",
    "implements": "接口",
    "interface": "接口",
    "abstract": "抽象类",
    "private": "封装",
    "protected": "封装",
    "public": "封装",
    "this": "对象",
    "super": "继承",
    "new": "对象",
}
#: Terms that name one entity, replaced one after the other in this order before concepts are looked for.
ENTITY_TERMS = (
    ("OOP", "面向对象编程"),
    ("面向对象", "面向对象编程"),
    ("面向对象程序设计", "面向对象编程"),
    ("ProgrammingParadigm", "面向对象编程"),
    ("object-oriented programming", "面向对象编程"),
    ("class", "类"),
    ("object", "对象"),
    ("method", "方法"),
    ("field", "属性"),
    ("member variable", "属性"),
    ("constructor", "构造方法"),
    ("inheritance", "继承"),
    ("polymorphism", "多态"),
    ("encapsulation", "封装"),
    ("interface", "接口"),
)
#: The schema of what rules extract from chunks; examples are heads here.
EXTRACTED_TYPES = ("ProgrammingParadigm", "OOPConcept", "SyntaxRule", "CodeStructure", "CodeExample", "ProgrammingLanguage", "Exercise", "Skill", "ErrorPattern")
EXTRACTED_SCHEMA = {
    "belongs_to_paradigm": (("OOPConcept", "SyntaxRule", "CodeStructure"), ("ProgrammingParadigm",)),
    "part_of": (("OOPConcept", "SyntaxRule", "CodeStructure"), ("OOPConcept", "CodeStructure")),
    "prerequisite_of": (("OOPConcept",), ("OOPConcept",)),
    "implemented_in": (("ProgrammingParadigm", "OOPConcept", "SyntaxRule", "CodeStructure"), ("ProgrammingLanguage",)),
    "has_syntax": (("OOPConcept",), ("SyntaxRule",)),
    "expresses_concept": (("SyntaxRule",), ("OOPConcept",)),
    "has_code_structure": (("OOPConcept",), ("CodeStructure",)),
    "demonstrates": (("CodeExample",), ("OOPConcept",)),
    "uses_syntax": (("CodeExample",), ("SyntaxRule",)),
    "contains_structure": (("CodeExample",), ("CodeStructure",)),
    "assesses": (("Exercise",), ("OOPConcept", "Skill")),
    "requires_skill": (("OOPConcept", "Exercise", "CodeExample"), ("Skill",)),
    "may_cause": (("OOPConcept", "Skill"), ("ErrorPattern",)),
    "confused_with": (("OOPConcept", "SyntaxRule"), ("OOPConcept", "SyntaxRule")),
    "equivalent_to": (EXTRACTED_TYPES, EXTRACTED_TYPES),
    "differs_from": (("OOPConcept", "SyntaxRule", "ProgrammingLanguage"), ("OOPConcept", "SyntaxRule", "ProgrammingLanguage")),
    "inherits_from": (("CodeStructure",), ("CodeStructure",)),
    "implements_interface": (("CodeStructure",), ("CodeStructure",)),
}
#: Names whose type is given whatever was said of them.
FORCED_TYPES = {**{c: "OOPConcept" for c in CONCEPTS}, "面向对象编程": "ProgrammingParadigm", "Alan Kay的OOP五大原则": "OOPConcept", "OOP五大原则": "OOPConcept", "Java对象": "OOPConcept"}
#: Labels of single nodes, whatever their name.
LABEL_OVERRIDES = {
    "course_python": "python",
    "course_java": "java",
    "course_cpp": "c++",
    "course_data_structures": "数据结构",
    "course_uml": "uml建模设计与分析",
    "curriculum_l11_1": "数据流模型",
}
