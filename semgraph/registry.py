"""Queries with the SQL that they equal, and the relations that both sides read.

A relation is a few hand-made rows, which hold the odd cases, and under the
same columns rows that are derived from the given tables and grow with them.
"""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with SQL for the same rows if there is any."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The hand-made rows, in SQL that Spark and the oracle both read.
FIXTURES = {
    "constraints": """SELECT 'lake' AS table_catalog, 'main' AS table_schema, t.table_name, t.column_name, 'PRIMARY KEY' AS constraint_type, 1 AS ordinal_position, concat('pk_', t.table_name) AS constraint_name
      FROM (VALUES ('region','regionkey'),('nation','nationkey'),('customer','custkey'),('supplier','suppkey'),('part','partkey'),('orders','orderkey'),('events','event_id'),('documents','doc_id'),('embeddings','vec_id'),('pages','page_id'),('benchmark','item_id')) AS t(table_name, column_name)""",
    "shop_columns": """SELECT 'cat' AS table_catalog, t.s AS table_schema, t.t AS table_name, t.c AS column_name, t.d AS data_type, 'YES' AS is_nullable, t.o AS ordinal_position, t.m AS comment
      FROM (VALUES ('sales','customers','id','BIGINT',1,'Customer identifier key'),('sales','customers','email','STRING',2,'Contact address'),('sales','orders','id','BIGINT',1,'Order number'),
        ('sales','orders','customer_id','INT',2,'Customer who ordered'),('sales','orders','total','DECIMAL(14,2)',3,CAST(NULL AS VARCHAR(9))),('sales','boxes','id','BIGINT',1,''),('sales','items','order_ref','BIGINT',1,'Order this belongs to'),
        ('sales','items','box_fk','BIGINT',2,NULL),('sales','items','order_id','BIGINT',3,'the Order number of the line'),('sales','codes','code','VARCHAR(9)',1,'Unique code'),('sales','uses','code','STRING',1,'Code in use'),('hr','staff','staff_id','BIGINT',1,NULL),('hr','leave','staff_id','BIGINT',1,NULL)) AS t(s, t, c, d, o, m)""",
    "shop_keys": """SELECT 'cat' AS table_catalog, t.s AS table_schema, t.t AS table_name, t.c AS column_name, t.k AS constraint_type, t.o AS ordinal_position, t.n AS constraint_name
      FROM (VALUES ('sales','customers','id','PRIMARY KEY',1,'pk_customers'),('sales','orders','id','PRIMARY KEY',1,'pk_orders'),('sales','codes','code','UNIQUE',1,'uq_codes'),('sales','items','order_ref','PRIMARY KEY',1,'pk_items'),('sales','items','box_fk','PRIMARY KEY',2,'pk_items')) AS t(s, t, c, k, o, n)""",
    "fan_columns": """SELECT 'cat' AS table_catalog, 's' AS table_schema, concat('t', CAST(i AS VARCHAR(9))) AS table_name, 'shared_key' AS column_name, 'INT' AS data_type, 'YES' AS is_nullable, 1 AS ordinal_position, CAST(NULL AS VARCHAR(9)) AS comment FROM (VALUES (1),(2),(3),(4)) AS t(i)""",
    "fan_keys": """SELECT 'cat' AS table_catalog, 's' AS table_schema, concat('t', CAST(i AS VARCHAR(9))) AS table_name, 'shared_key' AS column_name, 'PRIMARY KEY' AS constraint_type, 1 AS ordinal_position, concat('pk', CAST(i AS VARCHAR(9))) AS constraint_name FROM (VALUES (1),(2),(3)) AS t(i)""",
    "referential": """SELECT t.c AS constraint_catalog, t.s AS constraint_schema, t.n AS constraint_name, t.c AS unique_constraint_catalog, t.us AS unique_constraint_schema, t.un AS unique_constraint_name
      FROM (VALUES ('cat','sales','fk_orders','sales','pk_customers'),('cat','sales','fk_items','sales','pk_pair'),('cat','sales','fk_lost','sales','pk_gone'),('cat','hr','fk_boss','hr','pk_staff'),('cat2','sales','fk_orders','sales','pk_gone'),('cat2','hr','fk_boss','hr','pk_staff')) AS t(c, s, n, us, un)""",
    "key_usage": """SELECT t.k AS constraint_catalog, t.s AS constraint_schema, t.n AS constraint_name, t.k AS table_catalog, t.s AS table_schema, t.t AS table_name, t.c AS column_name, t.o AS ordinal_position, t.p AS position_in_unique_constraint
      FROM (VALUES ('cat','sales','fk_orders','orders','customer_id',1,1),('cat','sales','pk_customers','customers','id',1,CAST(NULL AS INT)),('cat','sales','fk_items','items','b',1,2),('cat','sales','fk_items','items','a',2,1),
        ('cat','sales','pk_pair','pairs','x',1,NULL),('cat','sales','pk_pair','pairs','y',2,NULL),('cat','sales','fk_lost','orders','gone',1,1),('cat','hr','fk_boss','staff','Boss_ID',1,1),('cat','hr','pk_staff','staff','id',1,NULL),
        ('cat2','sales','fk_orders','orders','customer_id',1,1),('cat2','hr','fk_boss','staff','boss_id',1,1),('cat2','hr','pk_staff','staff','id',1,NULL)) AS t(k, s, n, t, c, o, p)""",
    "type_names": """SELECT t FROM (VALUES ('string'),(' VARCHAR(20) '),('char(3)'),('decimal(14,2)'),('NUMERIC(9)'),('DECIMAL(14, 2)'),('bigint'),('Int'),('SMALLINT'),('double'),('array<int>'),('timestamp_ntz')) AS x(t)""",
    "vendor_types": """SELECT t FROM (VALUES ('int'),('VARCHAR(255)'),('nvarchar ( 40 )'),('decimal(50,60)'),('NUMBER(0,5)'),('DoublePrecision'),('double precision'),('UnsignedBigInt'),('TIMESTAMP WITHOUT TIME ZONE'),('bit(1)'),('geometry'),('text;'),('money'),('Enum'),('numeric(10)')) AS x(t)""",
    "sql_texts": """SELECT id, sql FROM (VALUES (1,'SELECT a FROM `lake`.`main`.`orders`'),(2,'select * from lake.main.orders o join other.x.y z on o.a = z.a'),(3,'DELETE FROM lake.main.orders'),(4,'SELECT 1; SELECT 2'),(5,' SELECT a FROM lake.main.orders; '),
        (6,'SELECT * FROM orders'),(7,'SELECT created_at FROM `LAKE`.`main`.`t`'),(8,'SELECT * FROM lake.information_schema.tables'),(9,'SELECT * FROM system . x.y'),(10,'WITH a AS (SELECT 1) SELECT * FROM a'),(11,'SELECT update FROM lake.a.b')) AS x(id, sql)""",
    "answers": """SELECT id, answer FROM (VALUES (1,concat('```sql', chr(10), 'SELECT 1', chr(10), '```')),(2,'  select a from b  '),(3,'I cannot answer'),(4,''),(5,CAST(NULL AS VARCHAR(9))),(6,concat('```', chr(10), 'WITH x AS (SELECT 1) SELECT * FROM x', chr(10), '```')),(7,'Selective')) AS x(id, answer)""",
    "questions": """SELECT question_id, question FROM (VALUES ('q1','How many steel bolts and copper widgets are listed per brand?'),('q2','Show all large gears'),('q3','Which is the sum of any?'),('q4','Find the Cold valve or the cold pump')) AS x(question_id, question)""",
    "arm_results": """SELECT arm, parsed, executed, non_empty, correct FROM (VALUES ('a',true,true,true,true),('a',true,true,false,CAST(NULL AS BOOLEAN)),('a',true,false,false,NULL),('a',false,false,false,NULL),('b',true,true,true,false),('b',true,true,true,true),('b',true,true,true,true),('c',false,false,false,NULL)) AS x(arm, parsed, executed, non_empty, correct)""",
    "traces": """SELECT question_id, target_schema, top_schema, c1, c2, c3 FROM (VALUES ('q1','s1','s1','c.s1.t.a','c.s1.t.b','c.s2.t.a'),('q2','s2','s1','c.s1.t.a','c.s1.t.b',CAST(NULL AS VARCHAR(20))),('q3',CAST(NULL AS VARCHAR(9)),'s1','c.s1.t.a',NULL,NULL),('q4','s3',NULL,NULL,NULL,NULL)) AS x(question_id, target_schema, top_schema, c1, c2, c3)""",
    "result_cells": """SELECT id, n_rows, n_columns, cell FROM (VALUES (1,1,1,'0'),(2,1,1,''),(3,1,1,CAST(NULL AS VARCHAR(9))),(4,1,1,'7'),(5,0,1,NULL),(6,1,2,'0'),(7,5,1,'0')) AS x(id, n_rows, n_columns, cell)""",
    "plan_columns": """SELECT s, t, p, c, d FROM (VALUES ('sp','Users',0,'ID','int'),('sp','Users',1,'Full Name','VARCHAR(40)'),('sp','Users',2,'full_name','text'),('sp','Users',3,'???','int'),('sp','2 Orders',0,'id','bigint'),('sp','2 Orders',1,'user id','int'),('sp','2 Orders',2,'9lives','geometry'),('sp','Empty',0,'!!','int')) AS x(s, t, p, c, d)""",
    "terms": """SELECT domain, term, required FROM (VALUES ('hr','employees',true),('hr','payroll',false),('hr','leave',false),('crm','leads',false),('crm','accounts',true),('crm','deals',false)) AS x(domain, term, required)""",
    "ddl_scripts": """SELECT ddl FROM (VALUES ('ALTER TABLE `c`.`s`.`orders` ADD CONSTRAINT fk_a FOREIGN KEY (customer_id) REFERENCES `c`.`s`.`customers` (id)'),('alter table c.s.items add constraint fk_b foreign key (order_id) references c.s.orders (ID)'),('SELECT 1')) AS x(ddl)""",
    "responses": """SELECT id, r FROM (VALUES (1,'{"choices":[{"message":{"content":"SELECT 1"}}]}'),(2,'{"result":"SELECT 2"}'),(3,'{"predictions":["SELECT 3"]}'),(4,'{"content":[{"text":"SELECT 4"}]}'),(5,'{"other":1}'),(6,'{"text":"SELECT 6"}')) AS x(id, r)""",
    "runs": """SELECT run_id, status, error, s, t, d, e, sampled, skipped, candidates, g, fk_declared, fk_resolved, fk_skipped FROM (VALUES ('r1','success',CAST(NULL AS VARCHAR(9)),4,19,16,16,9,1,10,1,16,16,0), ('','failed','lost',3,19,16,15,9,1,9,0,16,18,-2),
        (CAST(NULL AS VARCHAR(9)),'success',NULL,5,20,17,17,5,5,10,2,17,16,2), ('r4',CAST(NULL AS VARCHAR(9)),NULL,9,9,9,9,2,0,1,0,9,9,0)) AS x(run_id, status, error, s, t, d, e, sampled, skipped, candidates, g, fk_declared, fk_resolved, fk_skipped)""",
    "edges_there": """SELECT source_id, target_id FROM (VALUES ('c.s.orders.customer_id', 'c.s.customers.id'), ('c.s.x.y', 'c.s.z.id')) AS x(source_id, target_id)""",
    "schema_names": """SELECT name FROM (VALUES ('Sales-EU'),('hr'),('Other'),(CAST(NULL AS VARCHAR(9)))) AS x(name)""",
    "schemas_chosen": """SELECT question_id, chosen FROM (VALUES ('q1','sales-eu'),('q1','hr'),('q2','gone')) AS x(question_id, chosen)""",
    "catalog_lists": """SELECT id, listed FROM (VALUES (-1,'gold:g, silver, gold:x, bronze:b'),(-2,' ')) AS x(id, listed)""",
    "asked": """SELECT question_id, question FROM (VALUES ('q1','How many steel bolts are listed?')) AS x(question_id, question)""",
    "batch_questions": """SELECT question_id, shape, sql FROM (VALUES ('a1','join','SELECT x FROM `lake`.`s1`.`t1`'),('a2','join',' SELECT x FROM `lake`.`s1`.`t1` '),('a3','window','SELECT y FROM `lake`.`s2`.`t2`'),('a4',CAST(NULL AS VARCHAR(9)),'SELECT z FROM `lake`.`s2`.`t3`'),('a5','agg','DROP TABLE `lake`.`s2`.`t3`'),('a6','agg','no sql')) AS x(question_id, shape, sql)""",
}


#: Rows from the given tables, named in braces: each customer and each order is a table of a shop's catalog, an
#: order's column refers to its customer's; parts give types, terms and blueprints; conversations give answers.
GROWN = {
    "shop_columns": """SELECT 'shop' AS table_catalog, 'sales' AS table_schema, 'c' || c_custkey || 's' AS table_name, 'id' AS column_name, 'BIGINT' AS data_type, 'YES' AS is_nullable, 1 AS ordinal_position, c_name AS comment FROM {customer}
      UNION ALL SELECT 'shop', 'sales', 'o' || o_orderkey, 'c' || o_custkey || '_id', CASE WHEN o_orderstatus = 'P' THEN 'STRING' ELSE 'INT' END, 'YES', 1, CASE WHEN o_orderkey % 2 = 0 THEN 'a customer' ELSE o_orderpriority END FROM {orders}""",
    "shop_keys": """SELECT 'shop' AS table_catalog, 'sales' AS table_schema, 'c' || c_custkey || 's' AS table_name, 'id' AS column_name, CASE WHEN c_acctbal > 5000 THEN 'UNIQUE' ELSE 'PRIMARY KEY' END AS constraint_type, 1 AS ordinal_position, 'pk_c' || c_custkey AS constraint_name FROM {customer} WHERE c_acctbal > 0""",
    "fan_columns": """SELECT DISTINCT 'shop' AS table_catalog, 'lines' AS table_schema, 'o' || l_orderkey AS table_name, 'part_' || l_partkey AS column_name, 'INT' AS data_type, 'YES' AS is_nullable, 1 AS ordinal_position, CAST(NULL AS VARCHAR(9)) AS comment FROM {lineitem}""",
    "fan_keys": """SELECT DISTINCT 'shop' AS table_catalog, 'lines' AS table_schema, 'o' || l_orderkey AS table_name, 'part_' || l_partkey AS column_name, 'PRIMARY KEY' AS constraint_type, 1 AS ordinal_position, 'pk_' || l_orderkey || '_' || l_partkey AS constraint_name FROM {lineitem} WHERE l_orderkey % 12 = 0""",
    "referential": """SELECT 'shop' AS constraint_catalog, CASE WHEN o_orderstatus = 'F' THEN 'sales' ELSE 'open' END AS constraint_schema, 'fk_o' || o_orderkey AS constraint_name, 'shop' AS unique_constraint_catalog, 'sales' AS unique_constraint_schema, 'pk_c' || o_custkey AS unique_constraint_name FROM {orders}""",
    "key_usage": """SELECT 'shop' AS constraint_catalog, CASE WHEN o_orderstatus = 'F' THEN 'sales' ELSE 'open' END AS constraint_schema, 'fk_o' || o_orderkey AS constraint_name, 'shop' AS table_catalog, 'sales' AS table_schema, 'o' || o_orderkey AS table_name, 'c' || o_custkey || '_id' AS column_name, 1 AS ordinal_position, 1 AS position_in_unique_constraint FROM {orders}
      UNION ALL SELECT 'shop', 'sales', 'pk_c' || c_custkey, 'shop', 'sales', 'c' || c_custkey || 's', 'id', 1, CAST(NULL AS INT) FROM {customer} WHERE c_acctbal > 0""",
    "type_names": """SELECT CASE p_partkey % 3 WHEN 0 THEN 'decimal(' || (p_partkey % 38 + 1) || ',' || p_size || ')' WHEN 1 THEN ' char(' || p_size || ')' ELSE p_type END AS t FROM {part}""",
    "vendor_types": """SELECT CASE p_partkey % 3 WHEN 0 THEN 'number(' || (p_partkey % 60) || ', ' || p_size || ');' WHEN 1 THEN ' nvarchar (' || p_size || ')' ELSE p_type END AS t FROM {part}""",
    "sql_texts": """SELECT 100 + c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'SELECT c_name FROM lake.main.customer' WHEN 1 THEN 'DELETE FROM lake.main.customer' WHEN 2 THEN 'SELECT c_name FROM lake.main.customer JOIN other.main.nation ON true' ELSE 'SELECT 1; SELECT c_name FROM lake.main.customer' END || ' WHERE c_nationkey = ' || c_nationkey || ' AND c_mktsegment = ''' || c_mktsegment || '''' AS sql FROM {customer}""",
    "answers": """SELECT 1000000 + 1000 * conv_id + turn AS id, CASE turn % 4 WHEN 0 THEN '```sql' || chr(10) || 'SELECT ' || text || chr(10) || '```' WHEN 1 THEN 'with ' || text WHEN 2 THEN text ELSE '  ```' || chr(10) || text || ' ```  ' END AS answer FROM {conversations}""",
    "asked": """SELECT 'b' || item_id AS question_id, text AS question FROM {benchmark} UNION ALL SELECT 'd' || doc_id, text FROM {documents}""",
    "arm_results": """SELECT o_orderpriority AS arm, o_orderstatus <> 'P' AS parsed, o_orderstatus = 'F' AS executed, o_orderstatus = 'F' AND o_orderkey % 5 <> 0 AS non_empty, CASE WHEN o_orderstatus = 'F' AND o_custkey % 3 <> 0 THEN o_custkey % 3 = 1 END AS correct FROM {orders}""",
    "result_cells": """SELECT 1000 + o_custkey AS id, count(*) AS n_rows, 1 + o_custkey % 2 AS n_columns, CASE o_custkey % 5 WHEN 1 THEN '0' WHEN 2 THEN '' WHEN 3 THEN min(o_orderstatus) END AS cell FROM {orders} GROUP BY o_custkey""",
    "plan_columns": """SELECT 'parts' AS s, p_brand || ' ' || (p_partkey - p_partkey % 20) AS t, CAST(row_number() OVER (PARTITION BY p_brand, p_partkey - p_partkey % 20 ORDER BY p_partkey) - 1 AS INT) AS p, p_name || ' ' || p_partkey AS c, CASE p_size % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'bigint' WHEN 2 THEN 'text' ELSE 'geometry' END AS d FROM {part}""",
    "terms": """SELECT lower(replace(p_brand, '#', '')) AS domain, replace(p_name, ' ', '_') || '_' || p_partkey AS term, p_size > 48 AS required FROM {part}""",
    "ddl_scripts": """SELECT 'ALTER TABLE `c`.`s`.`sup_' || s_suppkey || '` ADD CONSTRAINT fk_' || s_suppkey || ' FOREIGN KEY (nation_' || s_nationkey || ') REFERENCES `c`.`s`.`nation` (ID)' AS ddl FROM {supplier}""",
    "edges_there": """SELECT 'c.s.sup_' || s_suppkey || '.nation_' || s_nationkey AS source_id, CASE WHEN s_acctbal > 5000 THEN 'c.s.nation.key' ELSE 'c.s.nation.id' END AS target_id FROM {supplier} WHERE s_acctbal > 0""",
    "batch_questions": """SELECT 'c' || c_custkey AS question_id, CASE c_nationkey % 3 WHEN 0 THEN 'join' WHEN 1 THEN 'window' END AS shape, CASE c_custkey % 3 WHEN 0 THEN 'DROP TABLE' WHEN 1 THEN ' SELECT c_name FROM' ELSE 'SELECT c_name FROM' END || ' `lake`.`s' || c_nationkey || '`.`customer` WHERE c_mktsegment = ''' || c_mktsegment || '''' AS sql FROM {customer}""",
    "runs": """SELECT 'r' || o_orderkey AS run_id, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' END AS status, CASE WHEN o_orderstatus = 'P' THEN 'lost' END AS error, o_custkey % 8 AS s, o_orderkey % 40 AS t, o_custkey % 30 AS d, o_orderkey % 30 AS e, o_custkey % 10 AS sampled, o_orderkey % 3 AS skipped,
      o_custkey % 10 + o_custkey % 3 AS candidates, o_orderkey % 5 AS g, o_custkey % 30 AS fk_declared, o_orderkey % 20 AS fk_resolved, o_custkey % 30 - o_orderkey % 20 - CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS fk_skipped FROM {orders}""",
    "schema_names": """SELECT DISTINCT c_mktsegment AS name FROM {customer}""",
    "schemas_chosen": """SELECT 'c' || c_custkey AS question_id, lower(c_mktsegment) AS chosen FROM {customer}""",
    "catalog_lists": """SELECT c_custkey AS id, c_mktsegment || ':' || c_nationkey || ', ' || c_name || ',' || c_mktsegment || ':x' AS listed FROM {customer}""",
}


def fixture(spark: SparkSession, name: str, sf_dir: str | None = None) -> DataFrame:
    """The named relation; without ``sf_dir`` its hand-made rows alone."""
    made = spark.sql(FIXTURES[name])
    if sf_dir is None or name not in GROWN:
        return made
    named = {n for _, n, _, _ in Formatter().parse(GROWN[name]) if n}
    return made.unionByName(spark.sql(GROWN[name], **{n: table(spark, sf_dir, n) for n in named}))


def given(*names: str) -> str:
    """The named relations as common table expressions."""
    parts = {n: FIXTURES[n] + (" UNION ALL " + GROWN[n].replace("{", "").replace("}", "") if n in GROWN else "") for n in names}
    return ", ".join(f"{n} AS ({sql})" for n, sql in parts.items())
